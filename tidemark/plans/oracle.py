"""DuckDB restatements of every registered query, for the correctness gate.

The SQL is written from the original rules, independently of the Spark
operators: it re-derives the input views (ticks, filings) from the driver's
tables and computes each result with plain CASE / aggregate / window SQL.
Only the list of fact keys and the view-derivation constants are shared,
because they define the test input rather than the logic under test.

Results are presented the way the JSON staging sink writes them: dates as
ISO text, money as DOUBLE. An average is the exact sum of the doubles, rounded once,
over their count: here a sum of whole 128-bit numbers, in units that hold every bit.
"""

from __future__ import annotations

from tidemark.operators import sectors as S
from tidemark.plans import views as V

# ------------------------------------------------------------------ views

TICKS = """
ticks AS (
  SELECT lpad(hex(l_orderkey * 8 + l_linenumber), 24, '0') AS _id,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS "Date",
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS "Open",
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS "High",
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS "Low",
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4))
              * (1 + CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS "Close",
         CAST(l_quantity AS BIGINT) AS "Volume",
         l_discount AS "Dividends",
         l_tax AS "Stock Splits",
         CAST(l_suppkey AS VARCHAR) AS ticker,
         strftime(CAST(l_shipdate AS DATE) + 1, '%Y-%m-%d') || 'T'
           || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00:00' AS fetch_timestamp,
         l_orderkey * 8 + l_linenumber AS seq,
         l_returnflag,
         l_linenumber,
         l_shipdate
  FROM lineitem
)"""

AVG_NAMES = [("Open", "avg_open"), ("High", "avg_high"), ("Low", "avg_low"), ("Close", "avg_close"),
             ("Volume", "avg_volume"), ("Dividends", "avg_dividends"), ("Stock Splits", "avg_stock_splits")]


def exact_avg(x: str, bits: int = 70) -> str:
    """The exact sum of doubles whose last bit is 2^-bits at least, rounded once (text to DOUBLE rounds correctly), over their count."""
    return f"CAST(CAST(SUM(CAST(CAST({x} AS DOUBLE) * {2 ** bits}::DOUBLE AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {2 ** bits}::DOUBLE / COUNT({x})"


def _avgs(prefix: str = "") -> str:
    return ",\n  ".join(f'{exact_avg(f"""{prefix}"{m}\"""")} AS {out}' for m, out in AVG_NAMES)


def _filing_flat(where: str = "TRUE", g: str = "g", ff: str = "ff", revised: bool = False) -> str:
    conds = ["TRUE", "o_orderstatus = 'F'", "o_orderstatus = 'O'",
             "o_orderpriority IN ('1-URGENT', '2-HIGH')"]
    aggs = ",\n    ".join(
        f"SUM(CASE WHEN {c} THEN 1 ELSE 0 END) AS n{i}, "
        f"SUM(CASE WHEN {c} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS s{i}"
        for i, c in enumerate(conds)
    )
    seg = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.SEGMENT_SECTOR.items())
    facts = []
    for k, key in enumerate(V.numeric_fact_keys()):
        kind, mult = k % V.CONDITION_KINDS, k % V.MULTIPLIERS + 1 + (revised and k % 3 == 0)
        facts.append(
            f"CASE WHEN n{kind} = 0 THEN NULL WHEN (o_custkey + {k}) % {V.BLANK_EVERY} = 0 THEN '' "
            f"ELSE CAST(s{kind} * {mult} AS VARCHAR) END AS \"{key}\""
        )
    facts_sql = ",\n    ".join(facts)
    return f"""
{g} AS (
  SELECT o_custkey, year(o_orderdate) AS yr, quarter(o_orderdate) AS qt,
    {aggs}
  FROM orders WHERE {where} GROUP BY 1, 2, 3
),
{ff} AS (
  SELECT 'C' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS ticker,
    CAST(yr AS VARCHAR) AS tahun,
    'TW' || CAST(qt AS VARCHAR) AS triwulan,
    CASE WHEN o_custkey % {V.NULL_SECTOR_EVERY} <> 0
         THEN CASE c_mktsegment {seg} ELSE '{V.OTHER_SECTOR_LABEL}' END END AS "Subsector_CurrentYearInstant",
    c_name AS "EntityName_CurrentYearInstant",
    strftime(last_day(make_date(yr, qt * 3, 1)), '%Y-%m-%d') AS "CurrentPeriodEndDate_CurrentYearInstant",
    CASE WHEN c_nationkey < 12 THEN 'IDR' ELSE 'USD' END AS "DescriptionOfPresentationCurrency_CurrentYearInstant",
    CASE WHEN c_acctbal < 0 THEN 'Thousands' ELSE 'Full amount' END AS "LevelOfRoundingUsedInFinancialStatements_CurrentYearInstant",
    {facts_sql}
  FROM {g} JOIN customer ON o_custkey = c_custkey
)"""


FILINGS = _filing_flat()


def with_parts(parts: dict[str, tuple[str, bool]], body: str) -> str:
    """`part`s of the orders, by filter and whether revised, as one table `ff` of filings and one `rows` of sector rows, each with its part."""
    one = _filing_flat()
    chosen = " UNION ALL ".join(f"SELECT '{name}' AS part, * FROM orders WHERE {where}" for name, (where, _) in parts.items())
    anew = ", ".join(f"'{name}'" for name, (_, revised) in parts.items() if revised)
    one = one.replace("SELECT o_custkey, year", "SELECT part, o_custkey, year").replace("FROM orders WHERE TRUE GROUP BY 1, 2, 3", f"FROM ({chosen}) GROUP BY ALL")
    one = one.replace("SELECT 'C' ||", "SELECT part, 'C' ||", 1)
    if anew:
        for k, key in enumerate(V.numeric_fact_keys()):
            if k % 3 == 0:
                one = one.replace(f'* {k % V.MULTIPLIERS + 1} AS VARCHAR) END AS "{key}"', f'* ({k % V.MULTIPLIERS + 1} + (part IN ({anew}))::INT) AS VARCHAR) END AS "{key}"')
    rows = sector_all().replace("SELECT ", "SELECT part, ")
    return f"WITH {one},\nrows AS ({rows})\n{body}"

# ------------------------------------------------------- rule restatement


def f(name: str, ctx: str = "I") -> str:
    suffix = {"I": "CurrentYearInstant", "D": "CurrentYearDuration", "P": "PriorEndYearInstant"}[ctx]
    return f'"{name}_{suffix}"'


def n(x: str) -> str:
    return f"TRY_CAST({x} AS DECIMAL(38,6))"


def sum_if(*xs: str) -> str:
    """Sum of present terms when any is present; a present blank gives NULL."""
    cond = " OR ".join(f"{x} IS NOT NULL" for x in xs)
    total = " + ".join(f"(CASE WHEN {x} IS NULL THEN 0 ELSE {n(x)} END)" for x in xs)
    return f"(CASE WHEN {cond} THEN {total} END)"


def both_minus(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {n(a)} - {n(b)} END)"


def dbl(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,6)) AS DOUBLE)"


G3_INCOME = [f("IncomeFromBrokerageActivity", "D"), f("IncomeFromUnderwritingActivitiesAndSellingFees", "D"),
             f("IncomeFromInvestmentManagementServices", "D")]
G3_EXPENSE = f("GeneralAndAdministrativeExpenses", "D")
G4_PREMIUM = f("RevenueFromInsurancePremiums", "D")
G4_CLAIMS = [f("ClaimExpenses", "D"), f("ReinsuranceClaims", "D")]
OTHER_SHORT = [f("ShortTermBankLoans"), f("CurrentMaturitiesOfBankLoans"), f("OtherCurrentFinancialLiabilities"),
               f("ShortTermDerivativeFinancialLiabilities"), f("CurrentAdvancesFromCustomersThirdParties")]


def g3_gross() -> str:
    cond = "(" + " OR ".join(f"{x} IS NOT NULL" for x in G3_INCOME) + f") AND {G3_EXPENSE} IS NOT NULL"
    total = " + ".join(f"(CASE WHEN {x} IS NULL THEN 0 ELSE {n(x)} END)" for x in G3_INCOME)
    return f"(CASE WHEN {cond} THEN {total} - {n(G3_EXPENSE)} END)"


def g4_gross() -> str:
    cond = f"{G4_PREMIUM} IS NOT NULL AND (" + " OR ".join(f"{x} IS NOT NULL" for x in G4_CLAIMS) + ")"
    ded = " - ".join(f"(CASE WHEN {x} IS NULL THEN 0 ELSE {n(x)} END)" for x in G4_CLAIMS)
    return f"(CASE WHEN {cond} THEN {n(G4_PREMIUM)} - {ded} END)"


def other_short() -> str:
    return n("COALESCE(" + ", ".join(OTHER_SHORT) + ")")


# Sector -> column -> SQL expression (money columns only).
SECTOR_SQL = {
    S.BANKS: {
        "revenue": sum_if(f("InterestIncome", "D"), f("SubtotalShariaIncome", "D")),
        "gross_profit": n(f("ProfitFromOperation", "D")),
        "operating_profit": n(f("ProfitFromOperation", "D")),
        "cash": n(f("Cash")),
        "short_term_borrowing": sum_if(f("BorrowingsThirdParties"), f("BorrowingsRelatedParties")),
        "long_term_borrowing": sum_if(f("SubordinatedLoansThirdParties"), f("SubordinatedLoansRelatedParties")),
    },
    S.FINANCING: {
        "revenue": sum_if(f("IncomeFromMurabahahAndIstishna", "D"), f("IncomeFromConsumerFinancing", "D"),
                          f("IncomeFromFinanceLease", "D"), f("AdministrationIncome", "D"),
                          f("IncomeFromProvisionsAndCommissions", "D")),
        "gross_profit": sum_if(f("ProfitLossBeforeIncomeTax", "D"), f(S.DEPRECIATION, "D")),
        "operating_profit": n(f("ProfitLossBeforeIncomeTax", "D")),
        "cash": n(f("CashAndCashEquivalents")),
        "short_term_borrowing": sum_if(f("BorrowingsThirdParties"), f("CurrentAccountsWithOtherBanksThirdParties")),
        "long_term_borrowing": sum_if(f("BorrowingsRelatedParties"), f("BondsPayable"), f("Sukuk")),
    },
    S.INVESTMENT: {
        "revenue": sum_if(*G3_INCOME),
        "gross_profit": g3_gross(),
        "operating_profit": n(f("ProfitLossBeforeIncomeTax", "D")),
        "cash": n(f("CashAndCashEquivalents")),
        "short_term_borrowing": n(f("BankLoans")),
        "long_term_borrowing": both_minus(f("BankLoans", "P"), f("BankLoans")),
    },
    S.INSURANCE: {
        "revenue": n(G4_PREMIUM),
        "gross_profit": g4_gross(),
        "operating_profit": n(f("ProfitLossBeforeIncomeTax", "D")),
        "cash": n(f("CashAndCashEquivalents")),
        "short_term_borrowing": sum_if(f("ClaimPayables"), f("ReinsurancePayables")),
        "long_term_borrowing": n(f("InsuranceLiabilitiesForFuturePolicyBenefits")),
    },
    S.OTHER: {
        "revenue": n(f("SalesAndRevenue", "D")),
        "gross_profit": n(f("GrossProfit", "D")),
        "operating_profit": n(f("ProfitLossBeforeIncomeTax", "D")),
        "cash": n(f("CashAndCashEquivalents")),
        "short_term_borrowing": other_short(),
        "long_term_borrowing": n(f("LongTermBankLoans")),
    },
}
COMMON_SQL = {
    "net_profit": n(f("ProfitLoss", "D")),
    "total_assets": n(f("Assets")),
    "total_equity": n(f("Equity")),
    "liabilities": n(f("Liabilities")),
    "cash_dari_operasi": n(f("NetCashFlowsReceivedFromUsedInOperatingActivities", "D")),
    "cash_dari_investasi": n(f("NetCashFlowsReceivedFromUsedInInvestingActivities", "D")),
    "cash_dari_pendanaan": n(f("NetCashFlowsReceivedFromUsedInFinancingActivities", "D")),
}
MONEY_ORDER = ["revenue", "gross_profit", "operating_profit", "net_profit", "cash", "total_assets",
               "short_term_borrowing", "long_term_borrowing", "total_equity", "liabilities",
               "cash_dari_operasi", "cash_dari_investasi", "cash_dari_pendanaan"]
SECTOR_FACT = f("Subsector")
IDENTITY = (f'{f("EntityName")} AS entity_name, ticker AS emiten, tahun, triwulan, '
            f'{f("CurrentPeriodEndDate")} AS report_date, {f("DescriptionOfPresentationCurrency")} AS satuan, '
            f'{f("LevelOfRoundingUsedInFinancialStatements")} AS pembulatan')


def sector_select(sector: str, src: str = "ff") -> str:
    cols = []
    for c in MONEY_ORDER:
        expr = SECTOR_SQL[sector].get(c) or COMMON_SQL[c]
        cols.append(f"{dbl(expr)} AS {c}")
    if sector == S.OTHER:
        where = f"{SECTOR_FACT} NOT IN ('{S.BANKS}', '{S.FINANCING}', '{S.INVESTMENT}', '{S.INSURANCE}')"
    else:
        where = f"{SECTOR_FACT} = '{sector}'"
    return f"SELECT {IDENTITY},\n  " + ",\n  ".join(cols) + f"\nFROM {src} WHERE {where}"


def with_filings(body: str) -> str:
    return f"WITH {FILINGS}\n{body}"


def with_ticks(body: str, extra: str = "") -> str:
    return f"WITH {TICKS}{extra}\n{body}"


def sector_all(src: str = "ff") -> str:
    return "\nUNION ALL\n".join(sector_select(s, src) for s in S.SECTORS)


# ------------------------------------------------------------- registry


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    day = 'TRY_CAST("Date" AS DATE)'
    q["avg_daily"] = with_ticks(
        f"SELECT strftime({day}, '%Y-%m-%d') AS \"Date\", ticker,\n  {_avgs()}\nFROM ticks GROUP BY {day}, ticker")
    q["avg_monthly"] = with_ticks(
        f"SELECT CAST(year({day}) AS INTEGER) AS \"Year\", CAST(month({day}) AS INTEGER) AS \"Month\", ticker,\n"
        f"  {_avgs()}\nFROM ticks GROUP BY 1, 2, 3")
    q["avg_yearly"] = with_ticks(
        f"SELECT CAST(year({day}) AS INTEGER) AS \"Year\", ticker,\n  {_avgs()}\nFROM ticks GROUP BY 1, 2")
    q["avg_grouping_sets"] = with_ticks(
        f"SELECT 'daily' AS grain, strftime({day}, '%Y-%m-%d') AS \"Date\", CAST(NULL AS INTEGER) AS \"Year\", "
        f"CAST(NULL AS INTEGER) AS \"Month\", ticker, {_avgs()} FROM ticks GROUP BY {day}, ticker\n"
        f"UNION ALL SELECT 'monthly', NULL, CAST(year({day}) AS INTEGER), CAST(month({day}) AS INTEGER), ticker, "
        f"{_avgs()} FROM ticks GROUP BY 3, 4, 5\n"
        f"UNION ALL SELECT 'yearly', NULL, CAST(year({day}) AS INTEGER), NULL, ticker, {_avgs()} "
        f"FROM ticks GROUP BY 3, 5")
    q["avg_daily_latest_fetch"] = with_ticks(
        f"SELECT strftime({day}, '%Y-%m-%d') AS \"Date\", ticker,\n  {_avgs()}\n"
        f"FROM (SELECT *, row_number() OVER (PARTITION BY {day}, ticker ORDER BY fetch_timestamp DESC, _id DESC) AS rn"
        f" FROM ticks) WHERE rn = 1 GROUP BY {day}, ticker")
    q["month_to_date_ticks"] = with_ticks(
        f"SELECT _id, strftime({day}, '%Y-%m-%d') AS \"Date\", ticker, \"Close\" FROM ticks "
        f"WHERE {day} >= DATE '1998-08-01' AND {day} < DATE '1998-08-20'")

    # scalars
    q["reporting_period"] = (
        "SELECT strftime(d, '%Y-%m-%d') AS as_of,\n"
        "  CAST(CASE WHEN month(d) <= 3 THEN year(d) - 1 ELSE year(d) END AS INTEGER) AS period_year,\n"
        "  CAST(CASE WHEN month(d) <= 3 THEN 4 WHEN month(d) <= 6 THEN 1 WHEN month(d) <= 9 THEN 2 ELSE 3 END AS INTEGER)"
        " AS period_quarter\n"
        "FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)")
    q["iso_to_date"] = (
        "SELECT event_id, strftime(TRY_CAST(txt AS DATE), '%Y-%m-%d') AS parsed,\n"
        "  CAST(year(TRY_CAST(txt AS DATE)) AS INTEGER) AS \"Year\", CAST(month(TRY_CAST(txt AS DATE)) AS INTEGER) AS \"Month\"\n"
        "FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'not a date'"
        " WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d')"
        " ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS txt FROM events)")
    raw = ("raw AS (SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS ticker,\n"
           "  CASE l_linenumber WHEN 7 THEN 'nan' WHEN 6 THEN CASE WHEN l_orderkey % 2 = 1 THEN '' WHEN l_orderkey % 4 = 0 THEN '1.5f' ELSE '2d' END WHEN 5 THEN 'None' WHEN 4 THEN NULL"
           " ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS open_txt,\n"
           "  CASE l_linenumber WHEN 7 THEN 'nan' WHEN 6 THEN CASE WHEN l_orderkey % 2 = 1 THEN '' WHEN l_orderkey % 4 = 0 THEN '1.5f' ELSE '2d' END WHEN 5 THEN 'None' WHEN 4 THEN NULL"
           " ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(18,2))) AS VARCHAR) END AS high_txt,\n"
           "  CASE l_linenumber WHEN 7 THEN 'nan' WHEN 6 THEN CASE WHEN l_orderkey % 2 = 1 THEN '' WHEN l_orderkey % 4 = 0 THEN '1.5f' ELSE '2d' END WHEN 5 THEN 'None' WHEN 4 THEN NULL"
           " ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS VARCHAR) END AS low_txt,\n"
           "  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS VARCHAR) AS close_txt,\n"
           "  CASE l_linenumber WHEN 7 THEN 'nan' WHEN 6 THEN CASE WHEN l_orderkey % 2 = 1 THEN '' WHEN l_orderkey % 4 = 0 THEN '1.5f' ELSE '2d' END WHEN 5 THEN 'None' WHEN 4 THEN NULL"
           " WHEN 3 THEN '-' || CAST(CAST(l_tax AS DECIMAL(18,2)) + CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)"
           " WHEN 2 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'e1'"
           " ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS volume_txt,\n"
           "  CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) END AS div_txt,\n"
           "  l_shipdate\n"
           "FROM lineitem)")

    def sf(x):
        return f"COALESCE(CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN 0.0 ELSE TRY_CAST({x} AS DOUBLE) END, 0.0)"

    def si(x):
        return f"COALESCE(TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS BIGINT), 0)"

    q["safe_float"] = (f"WITH {raw}\nSELECT l_orderkey, l_linenumber, {sf('open_txt')} AS \"Open\", "
                       f"{sf('div_txt')} AS \"Dividends\" FROM raw")
    q["safe_int"] = f"WITH {raw}\nSELECT l_orderkey, l_linenumber, {si('volume_txt')} AS \"Volume\" FROM raw"
    q["price_frame_rows"] = (
        f"WITH {raw}\nSELECT ticker || '.JK' AS symbol, ticker, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS \"Date\",\n"
        f"  {sf('open_txt')} AS \"Open\", {sf('high_txt')} AS \"High\", {sf('low_txt')} AS \"Low\",\n"
        f"  {sf('close_txt')} AS \"Close\", {si('volume_txt')} AS \"Volume\", {sf('div_txt')} AS \"Dividends\",\n"
        f"  CAST(0.0 AS DOUBLE) AS \"Stock Splits\" FROM raw")
    q["fetch_manifest"] = with_filings(
        "SELECT ticker, tahun, triwulan, ticker || '.JK' AS symbol,\n"
        "  'https://example.invalid/reports/Laporan%20Keuangan%20Tahun%20' || tahun || '/' || triwulan || '/'"
        " || ticker || '/instance.zip' AS url,\n"
        "  ticker || '_' || tahun || '_' || triwulan || '.json' AS document_name FROM ff")

    keys = "ticker, tahun, triwulan"
    q["sum_if_any"] = with_filings(
        f"SELECT {keys}, {dbl(sum_if(f('BorrowingsRelatedParties'), f('BondsPayable'), f('Sukuk')))} AS value FROM ff")
    q["guarded_difference"] = with_filings(
        f"SELECT {keys}, {dbl(both_minus(f('BankLoans', 'P'), f('BankLoans')))} AS value FROM ff")
    q["sum_minus_required"] = with_filings(f"SELECT {keys}, {dbl(g3_gross())} AS value FROM ff")
    q["required_minus_optional"] = with_filings(f"SELECT {keys}, {dbl(g4_gross())} AS value FROM ff")
    q["first_present"] = with_filings(f"SELECT {keys}, {dbl(other_short())} AS value FROM ff")

    # sectors
    for name, sector in [("sector_banks", S.BANKS), ("sector_financing", S.FINANCING),
                         ("sector_investment", S.INVESTMENT), ("sector_insurance", S.INSURANCE),
                         ("sector_other", S.OTHER)]:
        q[name] = with_filings(sector_select(sector))
    q["sector_union"] = with_filings(sector_all())
    q["sector_one_pass"] = with_filings(sector_all())
    q["sector_one_pass_promoted"] = with_filings(sector_all())
    q["sector_rows_without_period"] = with_filings(
        f"SELECT * EXCLUDE (tahun, triwulan) FROM ({sector_all()})")
    q["sector_null_dropped"] = with_filings(f"SELECT {keys} FROM ff WHERE {SECTOR_FACT} IS NULL")
    q["unparsed_facts"] = with_filings(
        f"SELECT {keys}, {dbl(n('sales_int || repeat(chr(48), 12)'))} AS wide, {dbl(n(chr(39) + '1.234567' + chr(39)))} AS fine,"
        f" CAST(CASE WHEN sales_int IS NULL OR sales_int = '' THEN 0 ELSE 1 END AS INTEGER) AS n_unparsed,"
        f" CAST(CASE WHEN {n('sales_int || repeat(chr(48), 12)')} IS NULL THEN NULL ELSE 1 END AS INTEGER) AS n_parsed\n"
        f"FROM (SELECT *, split_part({f('Assets')}, '.', 1) AS sales_int FROM ff)")
    fine = [f"{exact_avg(x, bits)} AS {c}" for x, bits, c in (('(CAST("Open" AS DOUBLE) * 0.0000000012345::DOUBLE)', 100, "tiny"), ('(CAST("Open" AS DOUBLE) * 0.123456789123::DOUBLE)', 70, "fine"))]
    q["avg_fine_grained"] = with_ticks(f"SELECT strftime({day}, '%Y-%m-%d') AS \"Date\", ticker, {', '.join(fine)} FROM ticks GROUP BY {day}, ticker")
    q["target_names"] = (
        "SELECT DISTINCT y AS year, q AS quarter, 'filings_' || y || 'TW' || q || '_raw' AS name FROM (SELECT CASE WHEN month(d) <= 3 THEN year(d) - 1 ELSE year(d) END AS y,"
        " CASE WHEN month(d) <= 3 THEN 4 WHEN month(d) <= 6 THEN 1 WHEN month(d) <= 9 THEN 2 ELSE 3 END AS q FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders))")
    q["surrogate_ids"] = "SELECT COUNT(*) AS n, COUNT(*) AS n_distinct, 0 AS n_bad FROM lineitem"
    as_text = [f"coalesce({c}, '')" for c in ("entity_name", "emiten", "tahun", "triwulan", "report_date", "satuan", "pembulatan")]
    as_text += [f"coalesce(CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR), '')" for c in MONEY_ORDER]
    q["canonical_columns"] = with_filings(f"SELECT emiten, tahun, triwulan, concat_ws('|', {', '.join(as_text)}, 'end') AS row_text FROM ({sector_all()})")
    q["sorted_staging"] = with_filings(f"SELECT emiten, 0 AS out_of_order, COUNT(*) AS n FROM ({sector_all()}) GROUP BY emiten")
    q["sorted_json"] = q["sorted_staging"]
    q["counted_writes"] = with_filings("\nUNION ALL ".join(
        f"SELECT '{sector}' AS sector, COUNT(*) AS counted, COUNT(*) AS stored, COUNT(*) > 0 AS written FROM ({sector_select(sector)})" for sector in S.SECTORS)
        + "\nUNION ALL SELECT 'nobody''s', 0, 0, false")
    q["processed_dates"] = with_filings(f"SELECT COUNT(*) AS n, COUNT(*) AS n_iso FROM ff WHERE {_kind()} IN (0, 1)")
    q["malformed_instances"] = with_filings(
        "SELECT CASE WHEN CAST(substr(ticker, 2) AS INTEGER) % 5 = 0 THEN 'parse_error' ELSE 'ok' END AS status, COUNT(*) AS n FROM ff GROUP BY 1")
    q.update(merge_sql())
    q.update(ingest_sql(q))
    q["stream_monthly_average"] = q["avg_monthly"]
    q.update(job_sql(q))
    return q


# ------------------------------------------------------------------ merge

OLD_ORDERS = "o_orderdate < TIMESTAMP '1998-01-01 00:00:00'"
NEW_ORDERS = "o_orderdate >= TIMESTAMP '1997-07-01 00:00:00'"
OLD_TICKS = "l_shipdate < TIMESTAMP '1999-07-01 00:00:00'"
NEW_TICKS = "l_shipdate >= TIMESTAMP '1999-01-01 00:00:00'"
ALL_NEW_TICKS = NEW_TICKS
REVISED = """(SELECT * REPLACE (CASE WHEN l_returnflag <> 'N' OR l_linenumber > 3 THEN "Open" * 2 ELSE "Open" END AS "Open",
  CASE WHEN l_linenumber = 1 THEN NULL ELSE "Dividends" END AS "Dividends") FROM ticks)"""
DAY = 'TRY_CAST("Date" AS DATE)'


def _monthly_from(where: str, ticks: str = "ticks") -> str:
    return (f"SELECT CAST(year({DAY}) AS INTEGER) AS \"Year\", CAST(month({DAY}) AS INTEGER) AS \"Month\", ticker,"
            f"\n  {_avgs()}\nFROM {ticks} WHERE {where} GROUP BY 1, 2, 3")


def _yearly_from(where: str, ticks: str = "ticks") -> str:
    return (f"SELECT CAST(year({DAY}) AS INTEGER) AS \"Year\", ticker,\n  {_avgs()}\n"
            f"FROM {ticks} WHERE {where} GROUP BY 1, 2")


def _daily_from(where: str) -> str:
    return (f"SELECT strftime({DAY}, '%Y-%m-%d') AS \"Date\", ticker,\n  {_avgs()}\n"
            f"FROM ticks WHERE {where} GROUP BY {DAY}, ticker")


def _nsafe(keys: list[str], a: str = "o", b: str = "n") -> str:
    return " AND ".join(f'{a}."{k}" IS NOT DISTINCT FROM {b}."{k}"' for k in keys)


def _replace(old: str, new: str, keys: list[str]) -> str:
    return (f"WITH {TICKS}, old AS ({old}), new AS ({new})\n"
            f"SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE {_nsafe(keys)})\n"
            f"UNION ALL SELECT * FROM new")


def merge_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    fo = _filing_flat(OLD_ORDERS, "g_old", "ff_old")
    fn = _filing_flat(NEW_ORDERS, "g_new", "ff_new", revised=True)
    keys = ["ticker", "tahun", "triwulan"]
    count_present = " + ".join(f'(CASE WHEN "{k}" IS NOT NULL THEN 1 ELSE 0 END)' for k in S.rule_keys())
    summary = (f"CAST({count_present} AS INTEGER) AS n_facts, {SECTOR_FACT} AS sector, "
               f"{f('SalesAndRevenue', 'D')} AS sales_text, {f('Assets')} AS assets_text")
    q["replace_upsert_filings"] = (
        f"WITH {fo}, {fn}\n"
        f"SELECT ticker, tahun, triwulan, {summary} FROM ff_old o WHERE NOT EXISTS "
        f"(SELECT 1 FROM ff_new n WHERE {_nsafe(keys).replace('IS NOT DISTINCT FROM', '=')})\n"
        f"UNION ALL SELECT ticker, tahun, triwulan, {summary} FROM ff_new")
    ident = ["entity_name", "emiten", "tahun", "triwulan", "report_date", "satuan", "pembulatan"]
    coalesced = ", ".join(f"COALESCE(n.{c}, o.{c}) AS {c}" for c in ident + MONEY_ORDER)
    q["set_upsert_rows"] = (
        f"WITH {fo}, {fn}, old AS ({sector_all('ff_old')}), new AS ({sector_all('ff_new')})\n"
        f"SELECT {coalesced} FROM old o FULL OUTER JOIN new n "
        f"ON o.emiten = n.emiten AND o.tahun = n.tahun AND o.triwulan = n.triwulan")
    q["bucketed_upsert_rows"] = q["set_upsert_rows"]
    q["replace_upsert_monthly"] = _replace(_monthly_from(OLD_TICKS), _monthly_from(NEW_TICKS, REVISED), ["Year", "Month", "ticker"])
    q["replace_upsert_yearly"] = _replace(_yearly_from(OLD_TICKS), _yearly_from(NEW_TICKS, REVISED), ["Year", "ticker"])
    order = ["entity_name", "emiten", "tahun", "triwulan", "report_date", "satuan", "pembulatan", *MONEY_ORDER]
    fl = _filing_flat(NEW_ORDERS, "g_late", "ff_late")
    late = ", ".join(f"COALESCE(l.{c}, n.{c}, o.{c}) AS {c}" for c in order)
    same = "{a}.emiten = {b}.emiten AND {a}.tahun = {b}.tahun AND {a}.triwulan = {b}.triwulan"
    q["set_upsert_duplicate_keys"] = (
        f"WITH {fo}, {fn}, {fl}, old AS ({sector_all('ff_old')}), new AS ({sector_all('ff_new')}), late AS ({sector_all('ff_late')})\n"
        f"SELECT {late} FROM old o FULL OUTER JOIN new n ON {same.format(a='o', b='n')} LEFT JOIN late l ON {same.format(a='n', b='l')}")
    parts = {"old": (OLD_ORDERS, False), "late": (NEW_ORDERS, False)}
    q["replace_upsert_duplicate_keys"] = with_parts(parts, f"SELECT {', '.join(order)} FROM rows QUALIFY row_number() OVER (PARTITION BY emiten, tahun, triwulan ORDER BY part) = 1")
    moved = " OR ".join(f"(n.{c} IS NOT NULL AND n.{c} IS DISTINCT FROM o.{c})" for c in order if c not in ("emiten", "tahun", "triwulan"))
    q["merge_outcomes_set"] = (
        f"WITH {fo}, {fn}, old AS ({sector_all('ff_old')}), new AS ({sector_all('ff_new')})\n"
        f"SELECT CASE WHEN o.emiten IS NULL THEN 'inserted' WHEN n.emiten IS NULL THEN 'untouched' WHEN {moved} THEN 'updated' ELSE 'unchanged' END AS action, COUNT(*) AS n\n"
        f"FROM old o FULL OUTER JOIN new n ON {same.format(a='o', b='n')} GROUP BY 1")
    mk = ["Year", "Month", "ticker"]
    q["load_keeps_old_stamp"] = (
        f"WITH {TICKS}, old AS ({_monthly_from(OLD_TICKS)}), new AS ({_monthly_from(NEW_TICKS)})\n"
        f'SELECT COALESCE(n."Year", o."Year") AS "Year", COALESCE(n."Month", o."Month") AS "Month", COALESCE(n.ticker, o.ticker) AS ticker,'
        f" CASE WHEN n.ticker IS NULL THEN 'stored' ELSE 'loaded' END AS stamp FROM old o FULL OUTER JOIN new n ON {_nsafe(mk)}")
    changed = " OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for _, c in AVG_NAMES)
    q["merge_outcomes"] = (
        f"WITH {TICKS}, old AS ({_monthly_from(OLD_TICKS)}), new AS ({_monthly_from(NEW_TICKS, REVISED)})\n"
        f"SELECT action, COUNT(*) AS n FROM (SELECT CASE WHEN o.ticker IS NULL AND o.\"Year\" IS NULL THEN 'inserted'"
        f" WHEN n.ticker IS NULL AND n.\"Year\" IS NULL THEN 'untouched' WHEN {changed} THEN 'updated'"
        f" ELSE 'unchanged' END AS action FROM old o FULL OUTER JOIN new n ON {_nsafe(mk)}) GROUP BY action")
    q["last_write_wins"] = with_ticks(
        'SELECT "Date", ticker, seq, "Open", "Close" FROM (SELECT *, row_number() OVER '
        '(PARTITION BY "Date", ticker ORDER BY seq DESC) AS rn FROM ticks) WHERE rn = 1')
    q["set_fold_batch"] = with_ticks(
        'SELECT "Date", ticker, arg_max("Open", seq) FILTER (WHERE "Open" IS NOT NULL) AS "Open",'
        ' arg_max(c2, seq) FILTER (WHERE c2 IS NOT NULL) AS "Close",'
        ' arg_max(d2, seq) FILTER (WHERE d2 IS NOT NULL) AS "Dividends"'
        ' FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN NULL ELSE "Close" END AS c2,'
        ' CASE WHEN l_returnflag = \'R\' THEN NULL ELSE "Dividends" END AS d2 FROM ticks)'
        ' GROUP BY "Date", ticker')
    appended = f"{_daily_from(OLD_TICKS)}\nUNION ALL {_daily_from(ALL_NEW_TICKS)}"
    q["append_daily"] = with_ticks(appended)
    q["duplicate_keys"] = with_ticks(
        f'SELECT "Date", ticker, COUNT(*) AS n FROM ({appended}) GROUP BY "Date", ticker HAVING COUNT(*) > 1')
    bad_day = 'TRY_CAST(CASE WHEN l_linenumber = 7 THEN \'n/a\' ELSE "Date" END AS DATE)'
    q["required_keys"] = with_ticks(
        f'SELECT CAST(year({bad_day}) AS INTEGER) AS "Year", CAST(month({bad_day}) AS INTEGER) AS "Month", ticker,'
        f"\n  {_avgs()}\nFROM ticks GROUP BY 1, 2, 3 HAVING \"Year\" IS NOT NULL AND \"Month\" IS NOT NULL"
        f" AND ticker IS NOT NULL")
    return q


# ----------------------------------------------------------------- ingest


def _kind() -> str:
    return ("((CAST(substr(ticker, 2) AS INTEGER) + CAST(tahun AS INTEGER)"
            " + CAST(substr(triwulan, 3, 1) AS INTEGER)) % 4)")


def _unpivot() -> str:
    return ("(UNPIVOT ff ON COLUMNS(* EXCLUDE (ticker, tahun, triwulan)) INTO NAME key VALUE value)")


def ingest_sql(base: dict[str, str]) -> dict[str, str]:
    q: dict[str, str] = {}
    q["ticker_csv"] = "SELECT trim(n_name) AS ticker FROM nation"
    q["ticker_lines"] = "SELECT n_name || ',' || CAST(n_regionkey AS VARCHAR) AS ticker FROM nation"
    q["tick_appends"] = with_ticks('SELECT _id, "Date", ticker, "Open", "Close", "Volume", fetch_timestamp FROM ticks')
    q["staged_json_strict"] = base["avg_monthly"]
    monthly = base["avg_monthly"]
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for _, c in AVG_NAMES)
    # A record with a text year is kept, without a year; a line that is not JSON is not.
    q["staged_json_lenient"] = monthly + f"\nUNION ALL SELECT CAST(NULL AS INTEGER), 1, n_name, {nulls} FROM nation"
    q["staged_json_rejects"] = with_ticks(
        f"SELECT (SELECT COUNT(*) FROM region) AS malformed, (SELECT COUNT(*) FROM nation) AS mistyped,\n"
        f"  (SELECT COUNT(*) FROM nation) + COUNT(*) AS good FROM ({_monthly_from('TRUE')})")
    day = DAY
    q["staged_aggregates"] = with_ticks(
        f"SELECT 'daily_aggregation' AS aggregation_type, strftime({day}, '%Y-%m-%d') AS \"Date\","
        f" CAST(NULL AS INTEGER) AS \"Year\", CAST(NULL AS INTEGER) AS \"Month\", ticker,"
        f" {exact_avg('"Close"')} AS avg_close"
        f" FROM ticks GROUP BY {day}, ticker\n"
        f"UNION ALL SELECT 'monthly_aggregation', NULL, CAST(year({day}) AS INTEGER), CAST(month({day}) AS INTEGER),"
        f" ticker, {exact_avg('"Close"')} FROM ticks GROUP BY 3, 4, 5\n"
        f"UNION ALL SELECT 'yearly_aggregation', NULL, CAST(year({day}) AS INTEGER), NULL,"
        f" ticker, {exact_avg('"Close"')} FROM ticks GROUP BY 3, 5")
    q["staged_parquet"] = with_filings(sector_all())
    q["archive_members"] = with_filings(
        f"SELECT ticker, tahun, triwulan,"
        f" CASE {_kind()} WHEN 0 THEN 'instance.xbrl' WHEN 1 THEN 'Report/Instance.XBRL' END AS member,"
        f" CASE {_kind()} WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'no_instance' ELSE 'bad_zip' END AS status"
        f" FROM ff")
    split = ("regexp_extract(key, '^(.*)_([^_]*)$', 1) AS name, "
             "regexp_extract(key, '^(.*)_([^_]*)$', 2) AS context")
    q["xbrl_facts"] = with_filings(f"SELECT ticker, tahun, triwulan, key, {split}, value FROM {_unpivot()}")
    q["xbrl_last_wins"] = with_filings(f"SELECT ticker, tahun, triwulan, key, value FROM {_unpivot()}")
    count_present = " + ".join(f'(CASE WHEN "{k}" IS NOT NULL THEN 1 ELSE 0 END)' for k in S.rule_keys())
    q["filing_ingest"] = with_filings(f"SELECT ticker, tahun, triwulan, key, value FROM {_unpivot()} WHERE {_kind()} IN (0, 1)")
    q["filing_documents"] = with_filings(
        f"SELECT ticker, tahun, triwulan, CAST({count_present} AS INTEGER) AS n_facts,"
        f" 'instance.xbrl' AS instance_filename, {SECTOR_FACT} AS sector,"
        f" {f('ProfitLoss', 'D')} AS net_profit_text FROM ff WHERE {_kind()} IN (0, 1)")
    return q


# ------------------------------------------------------------------- jobs


def job_sql(base: dict[str, str]) -> dict[str, str]:
    q: dict[str, str] = {}
    keys = "emiten, tahun, triwulan"
    order = ["entity_name", "emiten", "tahun", "triwulan", "report_date", "satuan", "pembulatan", *MONEY_ORDER]
    avgs = ", ".join(out for _, out in AVG_NAMES)
    tenth = "CAST(substr(emiten, 2) AS INTEGER) % 10 = 0"
    q["month_to_date_store"] = base["month_to_date_ticks"]
    q["ingest_prices_job"] = f"SELECT * EXCLUDE (symbol), true AS has_id FROM ({base['price_frame_rows']})"
    # The later statement of a key counts per column: revised for every tenth customer, as filed for the others.
    parts = {"old": (OLD_ORDERS, False), "filed": (NEW_ORDERS, False), "revised": (NEW_ORDERS, True)}
    place = f"CASE part WHEN 'old' THEN 0 WHEN 'revised' THEN 2 ELSE CASE WHEN {tenth} THEN 1 ELSE 3 END END"
    last = ", ".join(f"arg_max({c}, {place}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in order if c not in ("emiten", "tahun", "triwulan"))
    q["load_sector_rows_job"] = with_parts(parts, f"SELECT {keys}, {last} FROM rows GROUP BY {keys}")
    daily = f"{_daily_from(OLD_TICKS)} UNION ALL {_daily_from(NEW_TICKS).replace('FROM ticks', 'FROM ' + REVISED)}"

    def replaced(old: str, new: str, by: list[str], kind: str, month: str) -> str:
        return (f"SELECT '{kind}_aggregation' AS aggregation_type, NULL AS \"Date\", \"Year\", {month} AS \"Month\", ticker, {avgs} FROM"
                f" (SELECT * FROM ({old}) o WHERE NOT EXISTS (SELECT 1 FROM ({new}) n WHERE {_nsafe(by)}) UNION ALL SELECT * FROM ({new}))")

    q["load_prices_job"] = with_ticks(
        f"SELECT 'daily_aggregation' AS aggregation_type, \"Date\", CAST(NULL AS INTEGER) AS \"Year\", CAST(NULL AS INTEGER) AS \"Month\", ticker, {avgs} FROM ({daily})"
        f"\nUNION ALL {replaced(_monthly_from(OLD_TICKS), _monthly_from(NEW_TICKS, REVISED), ['Year', 'Month', 'ticker'], 'monthly', chr(34) + 'Month' + chr(34))}"
        f"\nUNION ALL {replaced(_yearly_from(OLD_TICKS), _yearly_from(NEW_TICKS, REVISED), ['Year', 'ticker'], 'yearly', 'NULL')}")
    mk = ["Year", "Month", "ticker"]
    q["load_stamps"] = (
        f"WITH {TICKS}, old AS ({_monthly_from(OLD_TICKS)}), new AS ({_monthly_from(NEW_TICKS)})\n"
        f'SELECT COALESCE(n."Year", o."Year") AS "Year", COALESCE(n."Month", o."Month") AS "Month", COALESCE(n.ticker, o.ticker) AS ticker,'
        f" 'monthly_aggregation' AS aggregation_type, 2 AS n_stamps, n.ticker IS NOT NULL AS later FROM old o FULL OUTER JOIN new n ON {_nsafe(mk)}")
    q["load_rejects"] = "SELECT 'monthly_aggregation' AS aggregation_type, 'not JSON' AS reason, '{\"Year\": 1995, \"ticker\": \"' || r_name AS line FROM region"
    q["load_refuses_duplicates"] = with_parts({"old": (OLD_ORDERS, False)}, f"SELECT {keys}, CASE WHEN {tenth} THEN 2 ELSE 1 END AS n, total_assets, true AS refused FROM rows")
    period = "tahun = '1997' AND triwulan = 'TW2'"
    q["transform_filings_job"] = with_filings(
        f"SELECT *, COUNT(*) OVER () AS counted, (SELECT COUNT(*) FROM ff WHERE {period} AND {SECTOR_FACT} IS NULL) AS null_sector FROM ({sector_all()}) WHERE {period}")
    count_present = " + ".join(f'(CASE WHEN "{k}" IS NOT NULL THEN 1 ELSE 0 END)' for k in S.rule_keys())
    q["documents_per_ticker"] = with_filings(
        f"SELECT ticker, tahun, triwulan, 1 AS n_files, 1 AS n_documents, CAST({count_present} AS INTEGER) AS n_facts, {SECTOR_FACT} AS sector, {f('ProfitLoss', 'D')} AS net_profit_text FROM ff")
    q["incremental_averages"] = with_ticks(
        f"SELECT 'monthly' AS grain, * FROM ({_monthly_from('TRUE')})\nUNION ALL SELECT 'yearly', \"Year\", CAST(NULL AS INTEGER), * EXCLUDE (\"Year\") FROM ({_yearly_from('TRUE')})")
    return q
