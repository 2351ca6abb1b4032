"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens. Each window takes from every queue its
target share; what a window could not give exactly (a share is rarely a whole
number of tokens) is a deficit that later windows make up. The deficits carried
to any point have a closed form: serving queues in the order of virtual time,
where the i-th token of a queue with share p falls due at (2i + 1) / p, keeps
every queue within one token of its target at all times. So the tokens served
from each queue before window k follow from k alone (a search for the virtual
time at which 4096 k tokens are due), and each task cuts its documents on its
own: no state passes through one task, and windows and partitions carry the
same deficits. A queue that runs dry drops out and the others share its place.

All windows are full but the last, which is padded unless its length is a
power of two. Pieces of a window lie one behind the other in queue order.

Steps: tokenise once (ids as 16-bit little-endian bytes, staged); sum tokens
per (queue, block of ids) to place every document in its queue; cut. Only small
rows are shuffled, the texts and ids are not: places are joined back by row key.

Queues: the `MAX_QUEUES - 1` sources of most tokens have one each, all others
share the last; so the table of queues that is broadcast has a fixed bound.

Cases: NULL text is empty and has the end id only; a NULL source is a queue of
its own; repeated rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, portions, prepare, staged

WINDOW = 4096
END_ID = 2
MAX_QUEUES = 1024
REMEMBERED = 100_000
#: Shares are whole numbers out of this; ticks of virtual time per share unit.
SHARES = TICKS = 1 << 16

_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_RUNS = rf"^(?P<a>{_LETTERS})?(?:(?P<b>[!-&(-/:-@\[-`{{-~]+)(?P<c>{_LETTERS})?)?$"


class Remembered:
    """What `work` gave for short strings, those asked for last: `limit` of them, and as many from before.

    Held and looked up as Arrow columns: some 20 bytes an entry, a tenth of what Python's objects take.
    """

    def __init__(self, work: Callable[[str], bytes], limit: int = REMEMBERED):
        self.work, self.limit = work, limit
        self.now = self.before = pa.RecordBatch.from_arrays([pa.array([], pa.string()), pa.array([], pa.binary())], names=["key", "value"])

    def __len__(self) -> int:
        return len(self.now)

    def of(self, keys: pa.StringArray) -> pa.BinaryArray:
        """The value of each of some distinct keys."""
        held = pa.concat_arrays([self.now["key"], self.before["key"]])
        place = pc.index_in(keys, value_set=held).fill_null(-1).to_numpy().copy()
        new = place < 0
        place[new] = len(held) + np.arange(new.sum())
        worked = pa.array([self.work(k) for k in keys.filter(pa.array(new)).to_pylist()], pa.binary())
        values = pa.concat_arrays([self.now["value"], self.before["value"], worked]).take(pa.array(place))
        # Those of the batch before move up, as they were asked for.
        fresh = pa.array(np.flatnonzero((place >= len(self.now)) & (pc.binary_length(keys).to_numpy() <= 64))[-self.limit:])
        more = pa.RecordBatch.from_arrays([keys.take(fresh), values.take(fresh)], names=["key", "value"])
        if len(self.now) + len(more) > self.limit:
            self.now, self.before = more, self.now
        else:
            self.now = pa.RecordBatch.from_arrays([pa.concat_arrays([self.now[c], more[c]]) for c in ("key", "value")], names=["key", "value"])
        return values


class WordTokenizer:
    """Ids of whole texts by a tokenizer that never joins across white space.

    Texts are split in whole columns, and each distinct word of a column is looked
    up once. A word of Latin letters and ASCII punctuation is made of runs, which
    are encoded by the model and remembered (bounded); any other goes through the
    whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.words, self.runs = Remembered(self._word), Remembered(self._run)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.alias = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
        probe = self.tok.encode("Ab,c's <|x é", add_special_tokens=False).ids
        self.by_runs = self.tok.get_vocab_size() < 65536 and probe == [i for w in ["ab", ",", "c", "'s", "<|", "x", "é"] for i in self._model_ids(w)]

    def _model_ids(self, run: str) -> list[int]:
        # Printable ASCII stands for itself.
        return [t.id for t in self.model.tokenize(run if run.isascii() else "".join(self.alias[b] for b in run.encode()))]

    def _run(self, run: str) -> bytes:
        ids = self._model_ids(run)
        return struct.pack(f"<{len(ids)}H", *ids)

    def _word(self, word: str) -> bytes:
        return np.array(self.tok.encode(word, add_special_tokens=False).ids, "<u2").tobytes()

    def _distinct(self, words: pa.StringArray) -> pa.BinaryArray:
        if not self.by_runs:
            return self.words.of(words)
        parts = pc.extract_regex(words, _RUNS)
        other = pc.or_(parts.is_null(), pc.match_substring(words, "<|"))
        runs = pa.concat_arrays([pc.utf8_lower(parts.field(k).fill_null("")) for k in range(3)]).dictionary_encode()
        ids = self.runs.of(runs.dictionary).take(runs.indices)
        joined = pc.binary_join_element_wise(*(ids.slice(k * len(words), len(words)) for k in range(3)), b"")
        return pc.replace_with_mask(joined, other, self.words.of(words.filter(other)))

    def encode(self, texts: pa.Array) -> pa.BinaryArray:
        """Little-endian 16-bit ids of each text; none for NULL."""
        words = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        each = words.flatten().dictionary_encode()
        return pc.binary_join(pa.ListArray.from_arrays(words.offsets, self._distinct(each.dictionary).take(each.indices)), b"")


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task; Spark has the parallelism
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenized(docs: DataFrame, path: str, id_col: str, text_col: str, source_col: str, end_id: int = END_ID) -> DataFrame:
    """(row, id, source, n, ids): row is unique; ids are 16-bit bytes without the end id, n counts it."""
    prepare(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in portions(batches, "text"):
            ids = t.encode(b.column("text"))
            n = pc.add(pc.divide(pc.binary_length(ids).cast(pa.int64()), 2), 1)
            yield pa.RecordBatch.from_arrays([b.column("key"), n, ids], names=["key", "n", "ids"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source")).alias("key"), F.col(text_col).cast("string").alias("text"))
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    out = rows.mapInArrow(encode, StructType([StructField("key", rows.schema["key"].dataType), StructField("n", LongType()), StructField("ids", BinaryType())]))
    return staged(out.select("key.row", "key.id", "key.source", "n", "ids"), "pack-ids")


class Schedule:
    """Which tokens of which queue lie in which window."""

    def __init__(self, sizes: Sequence[int], shares: Sequence[int], window: int = WINDOW):
        self.size = np.asarray(sizes, np.int64)
        self.share = np.asarray(shares, np.int64)
        self.window = window
        self.total = int(self.size.sum())
        self.last_tick = int((((2 * self.size - 1) * TICKS) // self.share).max()) if len(self.size) else 0

    def due(self, tick: np.ndarray) -> np.ndarray:
        """Tokens of each queue that are due by a tick: shape (ticks, queues)."""
        reach = (np.asarray(tick, np.int64)[:, None] + 1) * self.share[None, :] - TICKS
        return np.clip(-(-reach // (2 * TICKS)), 0, self.size[None, :])

    def served_before(self, windows: np.ndarray) -> np.ndarray:
        """Tokens each queue has served before each window: shape (windows, queues)."""
        goal = np.minimum(np.asarray(windows, np.int64) * self.window, self.total)
        low, high = np.full(len(goal), -1, np.int64), np.full(len(goal), self.last_tick, np.int64)
        while (high - low > 1).any():  # low: fewer than goal are due; high: goal or more
            mid = (low + high) >> 1
            enough = self.due(mid).sum(axis=1) >= goal
            high, low = np.where(enough, mid, high), np.where(enough, low, mid)
        before, by = self.due(low), self.due(high)
        # Tokens due at one tick go in queue order.
        at_tick = by - before
        taken = np.clip((goal - before.sum(axis=1))[:, None] - (np.cumsum(at_tick, axis=1) - at_tick), 0, at_tick)
        return before + taken

    def window_of(self, queue: np.ndarray, index: np.ndarray) -> np.ndarray:
        """The window of the index-th token of a queue."""
        tick = ((2 * index + 1) * TICKS) // self.share[queue]
        by_then, earlier = self.due(tick), self.due(tick - 1)
        column = np.arange(len(self.size))[None, :]
        rank = np.where(column < queue[:, None], by_then, earlier).sum(axis=1) - earlier[np.arange(len(queue)), queue] + index
        return rank // self.window

    def pieces(self, queue: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cut documents [start, start + length) of their queues: (document, from, to, window, offset), relative to the document."""
        first, last = self.window_of(queue, start), self.window_of(queue, start + length - 1)
        many = last - first + 1
        doc = np.repeat(np.arange(len(queue)), many)
        window = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        needed, place = np.unique(np.concatenate([window, window + 1]), return_inverse=True)
        served = self.served_before(needed)
        a, b = place[:len(window)], place[len(window):]
        q = queue[doc]
        lo = np.maximum(served[a, q], start[doc])
        hi = np.minimum(served[b, q], start[doc] + length[doc])
        in_window = served[b] - served[a]
        ahead = (np.cumsum(in_window, axis=1) - in_window)[np.arange(len(window)), q]
        some = hi > lo
        return tuple(x[some] for x in (doc, lo - start[doc], hi - start[doc], window, ahead + lo - served[a, q]))


def queue_table(totals: DataFrame, targets: Mapping[str | None, float] | None = None, max_queues: int = MAX_QUEUES) -> tuple[list[str | None], list[int]]:
    """The named queues in order, and the shares of all (the last is for the rest).

    The driver sees at most `max_queues` rows. `targets` gives shares by source
    (0 or missing: its size); by default every queue's share is its size, so the
    mix is the same in every window to the end.
    """
    top = totals.orderBy(F.col("n").desc(), F.col("source").asc_nulls_last()).limit(max_queues - 1).collect()
    named = sorted(((r["source"], r["n"]) for r in top), key=lambda x: (x[0] is None, x[0] or ""))
    all_n = totals.agg(F.sum("n")).first()[0] or 0
    weigh = [float((targets or {}).get(s) or n) for s, n in named] + [float(max(0, all_n - sum(n for _, n in named)))]
    whole = sum(weigh) or 1.0
    return [s for s, _ in named], [max(1, round(w / whole * SHARES)) for w in weigh]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         window: int = WINDOW, end_id: int = END_ID, targets: Mapping[str | None, float] | None = None, max_queues: int = MAX_QUEUES, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded (length after padding), source; with `with_ids` also the ids."""
    spark = docs.sparkSession
    ids = tokenized(docs, tokenizer_path, id_col, text_col, source_col, end_id)
    names, shares = queue_table(ids.groupBy("source").agg(F.sum("n").alias("n")), targets, max_queues)

    # Places in the queues. Rows are numbered by input partition and then one by one, so a block of row numbers is a run of documents.
    number = spark.createDataFrame([(s, k) for k, s in enumerate(names)], "s string, queue int")
    rows = ids.select("row", "source", "n").join(F.broadcast(number), F.col("source").eqNullSafe(F.col("s")), "left").select(
        "row", "n", F.coalesce("queue", F.lit(len(names))).alias("queue"), F.expr("row div 256").alias("block"))
    blocks = rows.groupBy("queue", "block").agg(F.sum("n").alias("n"))
    # Blocks in order: first whole groups of blocks, then the blocks in each group, so that no task orders a whole queue.
    blocks = blocks.withColumn("group", F.expr("block div 65536"))
    groups = blocks.groupBy("queue", "group").agg(F.sum("n").alias("n"))
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy("queue")
    groups = groups.withColumn("base", F.coalesce(F.sum("n").over(before("queue", "group")), F.lit(0))).withColumn("queue_n", F.sum("n").over(total))
    sizes = {r["queue"]: r["queue_n"] for r in groups.groupBy("queue").agg(F.max("queue_n").alias("queue_n")).collect()}  # at most max_queues rows
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("n").over(before("queue", "group", "block")), F.lit(0))).join(
        groups.select("queue", "group", "base"), ["queue", "group"]).select("queue", "block", (F.col("base") + F.col("inside")).alias("first"))
    places = rows.withColumn("within", F.coalesce(F.sum("n").over(before("queue", "block", "row")), F.lit(0))).join(blocks, ["queue", "block"]).select(
        "row", "queue", (F.col("first") + F.col("within")).alias("place"))
    joined = ids.join(places, "row")

    size_of = [int(sizes.get(k, 0)) for k in range(len(shares))]
    plan = Schedule([n for n in size_of if n] or [0], [p for p, n in zip(shares, size_of, strict=True) if n] or [1], window)
    used = np.cumsum([n > 0 for n in size_of]) - 1  # queue -> its column in the plan
    prepare(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 1024):
            n = b.column("n").to_numpy()
            queue, place = used[b.column("queue").to_numpy()], b.column("place").to_numpy()
            whole = [np.append(np.frombuffer(x, "<u2"), np.uint16(end_id)).astype("<u4") for x in b.column("ids").to_pylist()]
            doc, lo, hi, at, offset = plan.pieces(queue, place, n)
            parts = [whole[d][x:y].tobytes() for d, x, y in zip(doc.tolist(), lo.tolist(), hi.tolist(), strict=True)]
            left = np.minimum(window, plan.total - at * window)
            padded = np.where(left & (left - 1), window, left)
            columns = [b.column("key").take(pa.array(doc)), pa.array(lo), pa.array(hi - lo), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(n[doc]), pa.array(at), pa.array(offset), pa.array(padded)]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(parts, pa.binary())] * with_ids], names=[f.name for f in schema.fields])
        pa.default_memory_pool().release_unused()

    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    source = joined.select(F.struct(F.col("id").alias("id"), F.col("source").alias("source")).alias("key"), "n", "ids", "queue", "place")
    schema = StructType([StructField("key", source.schema["key"].dataType)] + [StructField(c, LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded")] + [StructField("ids", BinaryType())] * with_ids)
    out = source.mapInArrow(cut, schema)
    return out.select(F.col("key.id").alias(id_col), *[f.name for f in schema.fields[1:]], F.col("key.source").alias(source_col))
