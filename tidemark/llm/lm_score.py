"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) P(word | class, history). The history
gives three features (the word before, the one before that as a skip, and the
pair of both, hashed); each owns a row of weights over the classes. The most
frequent words fill classes of `SLOTS` words, each of which has a second softmax
with rows hashed from (feature, class). Further known words fall in bands by
rank, where words follow their counts (the maximum-entropy solution for the
word's own feature). All words outside the table, and the unknown word, are one
more class: there a word has its count less an absolute discount, and the
unknown word what the discounts freed. The whole is one distribution over the
training words and the unknown word.

Training: counts are summed over all training texts. Weights start at the
unigram model; in each of `ROUNDS` rounds every task makes gradient steps over
its own texts of that round (each text is used once), and the moves are averaged
row by row, weighted by use, in two levels of grouping. The driver holds the
weights only, about 6 MB whatever the corpus.

Scoring: texts are scored in sparse numpy batches with the broadcast weights and
the table of the `TABLE` most frequent words. Counts of all other words are not
broadcast: their occurrences, which the table has rid of every hot word, meet
the counts in a join by hash, and are summed by document.

Cases: NULL text is empty and has its end token only; without training texts the
unknown word has probability one; repeated rows are scored each; a row without
id counts in the split as empty text; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, portions, prepare, remainder, staged, words

END = b""
TABLE = 65_536
CLASSES, SLOTS, HEAD_CLASSES = 32, 32, 25
BANDS = 6
SUFFIXES = 1024
PAIR_ROWS, WORD_ROWS = 1 << 14, 1 << 15
ROUNDS = 2
BATCH = 8192
RATE = 0.15
_FLUSH = 600_000
HEAD = HEAD_CLASSES * SLOTS
RARE = HEAD_CLASSES + BANDS  # the class of words outside the table
CONTEXTS = HEAD + BANDS + SUFFIXES + 1
START = CONTEXTS - 1
#: Rows of the weights: word before, skip, pair, then those of the second softmax.
SKIP_AT, PAIR_AT, WORD_AT = CONTEXTS, 2 * CONTEXTS, 2 * CONTEXTS + PAIR_ROWS
ROWS = WORD_AT + WORD_ROWS


def tokens(text: str | bytes | None) -> list[bytes]:
    out = words(text)
    out.append(END)
    return out


def token_columns(texts: pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """The distinct tokens of a column of texts; for each token, in order, which of them it is; how many tokens each text has."""
    large = pa.large_string()
    ended = pc.binary_join_element_wise(texts.cast(large).fill_null(""), pa.scalar(" ", large), pa.scalar("", large))
    split = pc.ascii_split_whitespace(pc.ascii_lower(ended))  # not of a slice: Arrow's lower case loses its offset
    each = split.flatten().dictionary_encode()
    found = each.dictionary.cast(pa.large_binary())
    index = each.indices.to_numpy().astype(np.int64)
    sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
    # The space behind each text leaves one empty string there, the end; spaces before a text leave another.
    last = np.cumsum(sizes) - 1
    keep = (pc.binary_length(found).to_numpy() > 0)[index]
    keep[last] = True
    return found, index[keep], np.diff(np.concatenate([[0], np.cumsum(keep)[last]]))


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, c) over all texts; each task sums before it sends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = [], 0

        def summed() -> pa.Table:
            found = pa.concat_tables(seen).group_by("word", use_threads=False).aggregate([("c", "sum")])
            return pa.table([found["word"], found["c_sum"]], names=["word", "c"])

        for b in portions(batches, "text"):
            found, each, _ = token_columns(b.column(0))
            counts = np.bincount(each, minlength=len(found))
            used = pa.array(counts > 0)  # the empty strings before texts are no tokens
            seen.append(pa.table([found.cast(pa.binary()).filter(used), pa.array(counts, pa.int64()).filter(used)], names=["word", "c"]))
            rows += len(seen[-1])
            if rows > _FLUSH:
                seen = [summed()]
                rows = len(seen[0])
                if rows > _FLUSH // 2:
                    yield from seen[0].to_batches()
                    seen, rows = [], 0
        if seen:
            yield from summed().to_batches()

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word binary, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Table:
    """The frequent words, by rank, and the sums that the other words need."""

    words: list[bytes]
    counts: np.ndarray
    total: int      # N: training tokens
    distinct: int   # V: training words
    rare_total: int
    rare_distinct: int
    discount: float

    def arrays(self) -> dict[str, np.ndarray]:
        """By code (rank, then SUFFIXES codes for other words): class, slot, context, log of the count + 1, log of the word's part in its band."""
        t = len(self.words)
        rank = np.arange(t)
        band = np.clip(np.floor(np.log2(np.maximum(rank, 1) / HEAD + 1e-9)).astype(int), 0, BANDS - 1)
        cls = np.where(rank < HEAD, rank % HEAD_CLASSES, HEAD_CLASSES + band)
        context = np.where(rank < HEAD, rank, HEAD + band)
        mass = np.bincount(cls, self.counts, CLASSES)
        part = np.where(rank < HEAD, 0.0, np.log(self.counts / np.maximum(mass[cls], 1)))
        more = np.full(SUFFIXES, RARE)
        return {
            "cls": np.concatenate([cls, more]).astype(np.int32), "slot": np.concatenate([np.where(rank < HEAD, rank // HEAD_CLASSES, 0), 0 * more]).astype(np.int32),
            "context": np.concatenate([context, HEAD + BANDS + np.arange(SUFFIXES)]).astype(np.int32),
            "base": np.concatenate([np.log10(self.counts + 1.0), 0.0 * more]), "part": np.concatenate([part, 0.0 * more]),
        }

    def biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the classes, and of the slots of the head classes: the unigram model."""
        a = self.arrays()
        t = len(self.words)
        mass = np.bincount(a["cls"][:t], self.counts, CLASSES)
        mass[RARE] += self.rare_total
        slots = np.full((CLASSES, SLOTS), -30.0, np.float32)
        head = min(t, HEAD)
        slots[a["cls"][:head], a["slot"][:head]] = np.log(self.counts[:head] / np.maximum(mass[a["cls"][:head]], 1))
        used = mass > 0
        used[RARE] = True
        return np.where(used, np.log(np.maximum(mass, 0.5) / max(self.total, 0.5)), -30.0).astype(np.float32), slots


class Codes(dict):
    """Word -> code; words outside the table by a hash of their ending, remembered up to a bound."""

    def __init__(self, table: list[bytes]):
        super().__init__((w, k) for k, w in enumerate(table))
        self.base, self.bound = len(table), len(table) + 200_000
        self.column = pa.array(table, pa.large_binary())

    def __missing__(self, word: bytes) -> int:
        code = self.base + zlib.crc32(word[-3:]) % SUFFIXES
        if len(self) < self.bound:
            self[word] = code
        return code

    def of(self, found: pa.LargeBinaryArray) -> np.ndarray:
        """The code of each of some distinct words."""
        code = pc.index_in(found, value_set=self.column).fill_null(-1).to_numpy().astype(np.int64)
        other = np.flatnonzero(code < 0)
        ends = pc.binary_slice(found.take(pa.array(other)), -3).dictionary_encode()
        hashed = np.array([zlib.crc32(e) % SUFFIXES for e in ends.dictionary.to_pylist()], np.int64)
        code[other] = self.base + hashed[ends.indices.to_numpy()]
        return code


def features(codes: np.ndarray, first: np.ndarray, arrays: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Rows of weights (3, n) for the classes and (2, n) for the words, with class and slot. `first` marks the first token of each text."""
    context = arrays["context"][codes].astype(np.int64)
    before = np.concatenate([[START], context[:-1]])
    before[first] = START
    skip = np.concatenate([[START], before[:-1]])
    skip[first] = START
    cls, slot = arrays["cls"][codes], arrays["slot"][codes]
    pair = PAIR_AT + ((before * 2_654_435_761 + skip * 40_503 + 977) >> 7) % PAIR_ROWS
    key = before * CLASSES + cls
    far = (skip + CONTEXTS) * CLASSES + cls
    return np.stack([before, SKIP_AT + skip, pair]), np.stack([WORD_AT + ((key * 2_654_435_761) >> 9) % WORD_ROWS, WORD_AT + ((far * 2_654_435_761) >> 9) % WORD_ROWS]), cls, slot


def log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return x


@dataclass
class Weights:
    table: Table
    rows: np.ndarray  # (ROWS, CLASSES)

    def __post_init__(self):
        self.class_bias, self.slot_bias = self.table.biases()

    def logs(self, by_class: np.ndarray, by_word: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log probabilities of the classes; of the slots, for tokens of head classes; which tokens those are."""
        classes = self.rows.take(by_class[0], axis=0)
        classes += self.class_bias
        for f in (1, 2):
            classes += self.rows.take(by_class[f], axis=0)
        head = np.flatnonzero(cls < HEAD_CLASSES)
        slots = self.slot_bias.take(cls[head], axis=0)
        for f in (0, 1):
            slots += self.rows.take(by_word[f, head], axis=0)
        classes, slots = log_softmax(classes), log_softmax(slots)
        return classes, slots, head


def token_logs(model: Weights, codes: np.ndarray, first: np.ndarray, arrays: dict[str, np.ndarray]) -> np.ndarray:
    """Natural log of each token's probability; of words outside the table, that of their class."""
    out = np.empty(len(codes))
    by_class, by_word, cls, slot = features(codes, first, arrays)
    for k in range(0, len(codes), BATCH):
        at = slice(k, k + BATCH)
        classes, slots, head = model.logs(by_class[:, at], by_word[:, at], cls[at])
        p = classes[np.arange(len(classes)), cls[at]].astype(np.float64)
        p[head] += slots[np.arange(len(head)), slot[at][head]]
        out[at] = p
    return out + arrays["part"][codes]


def row_sums(rows: np.ndarray, gradient: np.ndarray, few: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, how many tokens each has, and the sums of their gradients: `np.add.reduceat` of the sorted tokens, to the bit.

    Rows of `few` tokens or less are summed together, a token of each at a time; the others one by one.
    """
    order = np.argsort(rows.astype(np.uint16), kind="stable")  # ROWS fits; 16 bits are sorted by radix
    sorted_rows = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
    counts = np.diff(np.append(starts, len(rows)))
    sums = gradient.take(order[starts], axis=0)
    by_count = np.argsort(-counts.astype(np.int32), kind="stable")
    more = np.searchsorted(-counts[by_count], -np.arange(1, few + 1), "left")  # of how many rows there are over 1, 2, ... tokens
    short = by_count[more[-1]:more[0]]
    rest = gradient.take(order[starts[short] + 1], axis=0)
    for k in range(2, few):
        there = more[k - 1] - more[-1]
        rest[:there] += gradient.take(order[starts[short[:there]] + k], axis=0)
    sums[short] += rest
    for g in by_count[:more[-1]].tolist():
        long = gradient.take(order[starts[g] + 1:starts[g] + counts[g]], axis=0)
        sums[g] += np.add.reduce(np.ascontiguousarray(long.T), axis=1)
    return sorted_rows[starts], counts, sums


def train_on(model: Weights, codes: np.ndarray, first: np.ndarray, arrays: dict[str, np.ndarray], used: np.ndarray, seen: np.ndarray) -> None:
    """Gradient steps (Adagrad by row) over the tokens, in place; `used` counts the tokens of each row."""
    by_class, by_word, cls, slot = features(codes, first, arrays)

    def move(rows: np.ndarray, gradient: np.ndarray) -> None:
        unique, counts, sums = row_sums(rows, gradient)
        seen[unique] += (sums * sums).mean(axis=1)
        used[unique] += counts
        model.rows[unique] -= (RATE / np.sqrt(seen[unique]))[:, None] * sums

    for k in range(0, len(codes), BATCH):
        at = slice(k, k + BATCH)
        classes, slots, head = model.logs(by_class[:, at], by_word[:, at], cls[at])
        g = np.exp(classes)
        g[np.arange(len(g)), cls[at]] -= 1.0
        for f in range(3):
            move(by_class[f, at], g)
        if len(head):
            g = np.exp(slots)
            g[np.arange(len(head)), slot[at][head]] -= 1.0
            for f in range(2):
                move(by_word[f, at][head], g)


def _coded(texts: pa.Array, codes: Codes) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens and which each token is; the tokens' codes; how many tokens each text has, and where they begin."""
    found, each, sizes = token_columns(texts)
    return found, each, codes.of(found)[each], sizes, np.cumsum(sizes) - sizes


_BLOCK = 64


def train(docs: DataFrame, table: Table, text_col: str, id_col: str, rounds: int = ROUNDS) -> Weights:
    """Rounds of local gradient steps and averaging; each text is used in one round."""
    spark = docs.sparkSession
    model = Weights(table, np.zeros((ROWS, CLASSES), np.float32))
    if not table.words:
        return model
    # Some input partitions make one task, so that what tasks send stays a small part of what they read.
    tasks = max(spark.sparkContext.defaultParallelism, -(-docs.rdd.getNumPartitions() // 4))
    turn = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(23)), F.lit(rounds))
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start = shared.value
            own, arrays, codes = Weights(start.table, start.rows.copy()), start.table.arrays(), Codes(start.table.words)
            used, seen = np.zeros(ROWS), np.full(ROWS, 1e-6, np.float32)
            for b in chunks(batches):
                _, _, flat, _, first = _coded(b.column(0), codes)
                train_on(own, flat, first, arrays, used, seen)
            moved = (own.rows - start.rows).astype(np.float32)
            blocks = [j for j in range(0, ROWS, _BLOCK) if used[j:j + _BLOCK].any()]
            from pyspark import TaskContext

            salt = TaskContext.get().partitionId() % 16
            if blocks:
                yield pa.RecordBatch.from_arrays([
                    pa.array(blocks, pa.int32()), pa.array([salt] * len(blocks), pa.int32()),
                    pa.array([(used[j:j + _BLOCK]).astype(np.float32).tobytes() for j in blocks], pa.binary()),
                    pa.array([moved[j:j + _BLOCK].astype(np.float16).tobytes() for j in blocks], pa.binary())], names=["block", "salt", "used", "moved"])

        def merge(rows: pd.DataFrame) -> pd.DataFrame:
            used = np.stack([np.frombuffer(x, np.float32) for x in rows["used"]])
            moved = np.stack([np.frombuffer(x, np.float16).astype(np.float32).reshape(-1, CLASSES) for x in rows["moved"]])
            whole = used.sum(axis=0)
            mean = (used[:, :, None] * moved).sum(axis=0) / np.maximum(whole, 1.0)[:, None]
            return pd.DataFrame({"block": rows["block"].iloc[:1], "salt": [0], "used": [whole.astype(np.float32).tobytes()], "moved": [mean.astype(np.float16).tobytes()]})

        shape = "block int, salt int, used binary, moved binary"
        texts = docs.where(turn == k).select(F.col(text_col).cast("string").alias("text")).coalesce(tasks)
        moves = texts.mapInArrow(run, shape).groupBy("block", "salt").applyInPandas(merge, shape).groupBy("block").applyInPandas(merge, shape)
        rows = model.rows.copy()
        for r in moves.select("block", "moved").collect():  # ROWS rows of weights at most, whatever the corpus
            m = np.frombuffer(r["moved"], np.float16).astype(np.float32).reshape(-1, CLASSES)
            rows[r["block"]:r["block"] + len(m)] += m
        model = Weights(table, rows)
        shared.unpersist()
    return model


def frequent(counts: DataFrame, size: int = TABLE) -> Table:
    """The words above the lowest count, in steps of a sixteenth of an octave, that leaves `size` of them at most.

    The steps' histogram has some hundred rows, so the driver gets `size` words
    and no more, whatever the number of partitions.
    """
    step = F.floor(F.log2("c") * 16)
    steps = counts.where("c > 1").groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("c")).orderBy(F.col("step").desc()).collect()
    least, held = None, 0
    for r in steps:
        if held + r["n"] > size:
            break
        least, held = r["c"], held + r["n"]
    top = sorted(counts.where(F.col("c") >= least).collect(), key=lambda r: (-r["c"], bytes(r["word"]))) if held else []
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("n1"), F.count(F.when(F.col("c") == 2, 1)).alias("n2")).first()
    c = np.array([r["c"] for r in top], np.float64)
    total = int(sums["n"] or 0)
    discount = sums["n1"] / (sums["n1"] + 2 * sums["n2"]) if sums["n1"] else 0.5
    return Table([bytes(r["word"]) for r in top], c, total, int(sums["v"]), total - int(c.sum()), int(sums["v"]) - len(top), min(0.9, discount))


def score(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text", table_size: int = TABLE, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, training, n_tokens, n_known, train_tokens, base_score, score (log10). `training` is a condition on the row."""
    spark = docs.sparkSession
    prepare(spark)
    learn = docs.where(training)
    counts = staged(word_counts(learn, text_col).withColumn("wh", F.xxhash64("word")), "lm-counts")
    table = frequent(counts, table_size)
    shared = spark.sparkContext.broadcast(train(learn, table, text_col, id_col, rounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        arrays, codes, size = model.table.arrays(), Codes(model.table.words), len(model.table.words)
        for b in chunks(batches):
            found, each, flat, sizes, first = _coded(b.column("text"), codes)
            log = token_logs(model, flat, first, arrays)
            known = flat < size
            other = np.flatnonzero(~known)
            asked = np.unique(each[other])
            hashes = np.zeros(len(found), np.int64)
            hashes[asked] = np.array([xxhash.xxh64_intdigest(w, 42) for w in found.take(pa.array(asked)).to_pylist()], np.uint64).astype(np.int64)
            rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(other, np.append(first, len(flat))), pa.int32()), pa.array(hashes[each[other]]))
            yield pa.RecordBatch.from_arrays([
                b.column("key"), pa.array(sizes), pa.array(np.add.reduceat(known.astype(np.int64), first)),
                pa.array(np.add.reduceat(arrays["base"][flat], first)), pa.array(np.add.reduceat(log, first) / math.log(10)), rare], names=["key", "n", "known", "base", "score", "rare"])

    source = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("training")).alias("key"), F.col(text_col).cast("string").alias("text"))
    from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

    schema = StructType([StructField("key", source.schema["key"].dataType), StructField("n", LongType()), StructField("known", LongType()), StructField("base", DoubleType()), StructField("score", DoubleType()), StructField("rare", ArrayType(LongType()))])
    parts = staged(source.mapInArrow(run, schema).select("key.*", "n", "known", "base", "score", "rare"), "lm-parts")

    # Words outside the table meet their counts by hash; unknown words have none.
    whole = float(max(table.rare_total, 1))
    freed = table.discount * table.rare_distinct / whole if table.rare_total else 1.0
    asked = parts.select("row", F.explode("rare").alias("wh")).groupBy("row", "wh").agg(F.count("*").alias("tf"))
    met = asked.join(counts.select("wh", "c"), "wh", "left")
    by_row = met.groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("also"), F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("more_base"),
        F.sum(F.col("tf") * F.when(F.col("c").isNotNull(), F.log10((F.col("c") - table.discount) / whole)).otherwise(math.log10(freed))).alias("more"))
    spread = math.log10(table.total + table.distinct + 1)
    out = parts.join(by_row, "row", "left")
    return out.select(
        F.col("id").alias(id_col), "training", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(table.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n") * spread).alias("base_score"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))


def split_scores(docs: DataFrame, modulus: int = 7, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`score` with the rows of one remainder held out."""
    out = score(docs, remainder(id_col, modulus) != held, id_col, text_col)
    return out.select(id_col, (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
