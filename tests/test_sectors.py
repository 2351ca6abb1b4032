"""Sector rules: golden filings per sector, NULL sector, one pass = union."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sectors as S
from tidemark.plans import views as V
from tidemark.schemas import FILING, SECTOR_COLUMNS

D, I, P = S.D, S.I, S.P


def filing(spark, ticker, facts: dict):
    row = (None, ticker, "2024", "TW3",
           {k: (v, k.rsplit("_", 1)[1], k.rsplit("_", 1)[0]) for k, v in facts.items()}, None)
    return spark.createDataFrame([row], FILING)


def base(sector):
    f = {f"EntityName_{I}": "PT Example", f"CurrentPeriodEndDate_{I}": "2024-09-30",
         f"DescriptionOfPresentationCurrency_{I}": "IDR", f"LevelOfRoundingUsedInFinancialStatements_{I}": "Full"}
    if sector is not None:
        f[S.SECTOR_KEY] = sector
    return f


def rows(spark, facts, ticker="AAA"):
    out = S.sector_rows(filing(spark, ticker, facts)).collect()
    union = S.sector_rows_union(filing(spark, ticker, facts)).collect()
    assert out == union
    return out


def test_banks(spark):
    f = base(S.BANKS) | {f"InterestIncome_{D}": "100", f"ProfitFromOperation_{D}": "40", f"Cash_{I}": "5",
                         f"BorrowingsRelatedParties_{I}": "3", f"SubordinatedLoansThirdParties_{I}": ""}
    (r,) = rows(spark, f)
    assert r.revenue == Decimal("100") and r.gross_profit == r.operating_profit == Decimal("40")
    assert r.cash == Decimal("5") and r.short_term_borrowing == Decimal("3")
    assert r.long_term_borrowing is None  # a blank present component
    assert r.net_profit is None and r.emiten == "AAA" and r.entity_name == "PT Example"


def test_financing(spark):
    f = base(S.FINANCING) | {f"IncomeFromFinanceLease_{D}": "10", f"AdministrationIncome_{D}": "2.5",
                             f"ProfitLossBeforeIncomeTax_{D}": "7", f"BorrowingsThirdParties_{I}": "1",
                             f"BondsPayable_{I}": "4", f"Sukuk_{I}": "6", f"CashAndCashEquivalents_{I}": "9"}
    (r,) = rows(spark, f)
    assert r.revenue == Decimal("12.5") and r.gross_profit == Decimal("7") and r.operating_profit == Decimal("7")
    assert r.short_term_borrowing == Decimal("1") and r.long_term_borrowing == Decimal("10")
    assert r.cash == Decimal("9")


def test_investment(spark):
    f = base(S.INVESTMENT) | {f"IncomeFromBrokerageActivity_{D}": "50",
                              f"GeneralAndAdministrativeExpenses_{D}": "20",
                              f"BankLoans_{I}": "30", f"BankLoans_{P}": "45"}
    (r,) = rows(spark, f)
    assert r.revenue == Decimal("50") and r.gross_profit == Decimal("30")
    assert r.short_term_borrowing == Decimal("30") and r.long_term_borrowing == Decimal("15")
    # guard fails: expense absent / prior loans absent
    f2 = dict(f)
    del f2[f"GeneralAndAdministrativeExpenses_{D}"], f2[f"BankLoans_{P}"]
    (r2,) = rows(spark, f2)
    assert r2.gross_profit is None and r2.long_term_borrowing is None and r2.revenue == Decimal("50")


def test_insurance(spark):
    f = base(S.INSURANCE) | {f"RevenueFromInsurancePremiums_{D}": "80", f"ReinsuranceClaims_{D}": "15",
                             f"ClaimPayables_{I}": "2", f"InsuranceLiabilitiesForFuturePolicyBenefits_{I}": "11"}
    (r,) = rows(spark, f)
    assert r.revenue == Decimal("80") and r.gross_profit == Decimal("65")
    assert r.short_term_borrowing == Decimal("2") and r.long_term_borrowing == Decimal("11")
    f2 = dict(f)
    del f2[f"ReinsuranceClaims_{D}"]
    (r2,) = rows(spark, f2)
    assert r2.gross_profit is None  # no deduction present


def test_other(spark):
    f = base("Consumer Goods") | {f"SalesAndRevenue_{D}": "900", f"GrossProfit_{D}": "300",
                                  f"OtherCurrentFinancialLiabilities_{I}": "12",
                                  f"ShortTermDerivativeFinancialLiabilities_{I}": "13",
                                  f"LongTermBankLoans_{I}": "70", f"Equity_{I}": "1", f"Liabilities_{I}": "2",
                                  f"NetCashFlowsReceivedFromUsedInOperatingActivities_{D}": "-5"}
    (r,) = rows(spark, f)
    assert r.revenue == Decimal("900") and r.gross_profit == Decimal("300")
    assert r.short_term_borrowing == Decimal("12") and r.long_term_borrowing == Decimal("70")
    assert r.cash_dari_operasi == Decimal("-5") and r.total_equity == Decimal("1")
    # a blank first alternative wins the coalesce and parses to NULL
    f2 = f | {f"ShortTermBankLoans_{I}": ""}
    (r2,) = rows(spark, f2)
    assert r2.short_term_borrowing is None


def test_all_absent_and_null_sector(spark):
    (r,) = rows(spark, base(S.BANKS))
    assert all(getattr(r, c) is None for c in S.SECTOR_MONEY_COLUMNS)
    assert rows(spark, base(None)) == []
    assert S.dropped_null_sector(filing(spark, "X", base(None))).count() == 1


def test_output_columns(spark):
    out = S.sector_rows(filing(spark, "A", base(S.BANKS)))
    assert out.columns == SECTOR_COLUMNS
    assert S.sector_rows(filing(spark, "A", base(S.BANKS)), with_period=False).columns == [
        c for c in SECTOR_COLUMNS if c not in ("tahun", "triwulan")]


def test_union_equals_one_pass_on_tables(spark, sf):
    from tidemark.plans import views as V

    fl = V.filings(spark, sf)
    a, b = S.sector_rows(fl), S.sector_rows_union(fl)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_pass_reads_once(spark, sf):
    from tidemark.plans import views as V

    plan = S.sector_rows(V.filings(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # orders and customer, once each


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ansi_independent(spark, sf, ansi):
    from tidemark.plans import views as V

    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = sorted(S.sector_rows(V.filings(spark, sf)).collect())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    spark.conf.set("spark.sql.ansi.enabled", "false" if ansi == "true" else "true")
    try:
        other = sorted(S.sector_rows(V.filings(spark, sf)).collect())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert got == other


def test_promoted_layout_gives_same_rows(spark, sf, tmp_path):
    from tidemark.plans import views as V

    fl = V.filings(spark, sf)
    S.promote_rule_facts(fl).write.parquet(str(tmp_path / "promoted"))
    promoted = spark.read.parquet(str(tmp_path / "promoted"))
    a = S.sector_rows(fl)
    b = S.sector_rows(promoted)
    c = S.sector_rows_union(promoted)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and b.exceptAll(c).count() == 0
    assert S.dropped_null_sector(promoted).count() == S.dropped_null_sector(fl).count()
    scan = S.sector_rows(promoted)._jdf.queryExecution().executedPlan().toString()
    read_schema = scan.split("ReadSchema: ")[1].split("\n")[0]
    assert "facts:map" not in read_schema and "rule_facts:struct" in read_schema


def test_blank_as_missing_option(spark):
    f = base(S.BANKS) | {f"InterestIncome_{D}": "100", f"SubtotalShariaIncome_{D}": " "}
    fl = filing(spark, "AAA", f)
    assert S.sector_rows(fl).first().revenue is None  # default: blank present -> NULL sum
    assert S.sector_rows(fl, blank_as_missing=True).first().revenue == Decimal("100")
    assert S.sector_rows_union(fl, blank_as_missing=True).first().revenue == Decimal("100")


def test_map_path_plan_narrows_once(spark):
    fl = filing(spark, "AAA", base(S.BANKS) | {f"InterestIncome_{D}": "1"})
    plan = S.sector_rows(fl)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("map_filter(") == 1 and "INSET" in plan
    filt = [line for line in plan.splitlines() if "Filter" in line]
    assert filt and all("map_filter" not in line for line in filt)


def test_filings_agree_with_their_columns_and_no_filter_repeats_the_map(spark, tmp_path):
    sf = str(tmp_path)
    # Every customer remainder of the blank rule; prices that are NULL, alone in their period and beside others.
    spark.range(1, 25).selectExpr("id c_custkey", "concat('N', id) c_name", "id c_nationkey", "id - 5D c_acctbal", "element_at(array('MACHINERY', 'BUILDING', 'HOUSEHOLD'), int(id % 3) + 1) c_mktsegment").write.parquet(f"{sf}/customer.parquet")
    spark.range(200).selectExpr("id o_orderkey", "id % 24 + 1 o_custkey", "element_at(array('F', 'O', 'P'), int(id % 3) + 1) o_orderstatus", "CASE WHEN id % 4 > 0 THEN id * 1.25D END o_totalprice",
                                "date_add(DATE'1996-01-01', int(id % 5) * 80) o_orderdate", "element_at(array('1-URGENT', '5-LOW'), int(id % 2) + 1) o_orderpriority").write.parquet(f"{sf}/orders.parquet")
    for revised in (False, True):
        flat = {(r["ticker"], r["tahun"], r["triwulan"]): r.asDict() for r in V.filing_fact_columns(spark, sf, revised=revised).collect()}
        made = V.filings(spark, sf, revised=revised).select("ticker", "tahun", "triwulan", F.map_entries("facts").alias("facts")).collect()
        assert len(made) == len(flat)
        for r in made:
            want = {k: v for k, v in flat[r["ticker"], r["tahun"], r["triwulan"]].items() if k in S.rule_keys() and v is not None}
            assert [(k, f["value"], (f["name"], f["context"])) for k, f in r["facts"]] == [(k, want[k], V.split_key(k)) for k in S.rule_keys() if k in want]
    plan = S.sector_rows(V.filings(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_entries") == 1  # a pushed filter made the map again in the join
