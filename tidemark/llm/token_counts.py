"""Token counts by heap-and-linked-list byte-pair merging.

Counts the tokens a sentencepiece BPE model gives a text without making any
identifier. A text is normalised as the model says (a leading space mark, each
space a mark), cut at places no merge can cross, and every piece is merged on a
doubly linked list of symbols: a heap yields the best-ranked adjacent pair, the
left-most among equals; the pair becomes one symbol and offers its new pairs.
The count is symbols minus merges, plus the further bytes of characters that
have no entry of their own (byte fallback).

A cut is exact where the vocabulary has no entry that holds the two characters
side by side. Piece counts are remembered per worker (bounded; forgetting costs
time only), since most pieces of a corpus repeat.

Scale: one narrow pass, no shuffle; texts become Python objects a few at a time.

Cases: NULL text counts as empty (0 tokens); an empty table gives an empty
result; rows repeat as they come; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, prepare

MARK = "▁"
LIMIT = 4096
#: Pieces a worker remembers; the memory bound of the cache, not of the input.
REMEMBERED = 400_000


class PairMerger:
    """Token counts of one model's vocabulary."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.score: dict[str, float] = {}
        for i in range(sp.vocab_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
                self.score[sp.id_to_piece(i)] = sp.get_score(i)
        self.together = {p[k:k + 2] for p in self.score for k in range(len(p) - 1)}
        self.known: dict[str, int] = {}
        # A line break has no entry in these vocabularies unless one says so.
        breaks = "\n" if not any("\n" in p for p in self.score) else ""
        space_joins = any(pair[1] == MARK != pair[0] for pair in self.together)
        self.pieces = re.compile(".+" if space_joins else f"{MARK}+[^{MARK}{breaks}]*|[^{MARK}{breaks}]+|{breaks or MARK}", re.S).findall

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for piece in self.pieces(MARK + text.replace(" ", MARK)):
            n = known.get(piece)
            total += self._piece(piece) if n is None else n
        return total

    def _piece(self, piece: str) -> int:
        """Cut where no entry bridges, and merge each part."""
        total, start, together = 0, 0, self.together
        for k in range(1, len(piece) + 1):
            if k == len(piece) or piece[k - 1:k + 1] not in together:
                part = piece[start:k]
                n = self.known.get(part)
                if n is None:
                    n = self._remember(part, self.merge(part))
                total += n
                start = k
        return self._remember(piece, total)

    def _remember(self, piece: str, n: int) -> int:
        if len(piece) <= 64:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = n
        return n

    def merge(self, part: str) -> int:
        score, end = self.score, len(part)
        if end == 1:
            return 1 if part in score else len(part.encode("utf-8", "surrogatepass"))
        symbol: list[str] = list(part)
        left = list(range(-1, end - 1))
        right = list(range(1, end + 1))
        heap = []
        for k in range(end - 1):
            s = score.get(symbol[k] + symbol[k + 1])
            if s is not None:
                heap.append((-s, k, k + 1, 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, a, b, size = heapq.heappop(heap)
            # Gone or grown since it was offered.
            if not symbol[a] or not symbol[b] or len(symbol[a]) + len(symbol[b]) != size or right[a] != b:
                continue
            symbol[a] += symbol[b]
            symbol[b] = ""
            merges += 1
            nxt = right[a] = right[b]
            if nxt < end:
                left[nxt] = a
                s = score.get(symbol[a] + symbol[nxt])
                if s is not None:
                    heapq.heappush(heap, (-s, a, nxt, len(symbol[a]) + len(symbol[nxt])))
            prev = left[a]
            if prev >= 0:
                s = score.get(symbol[prev] + symbol[a])
                if s is not None:
                    heapq.heappush(heap, (-s, prev, a, len(symbol[prev]) + len(symbol[a])))
        fallback = sum(len(x.encode("utf-8", "surrogatepass")) - 1 for x in symbol if len(x) == 1 and x not in score)
        return end - merges + fallback


_MERGERS: dict[str, PairMerger] = {}


def merger(model_path: str) -> PairMerger:
    """One merger per worker and model, so that later batches find its memory."""
    if model_path not in _MERGERS:
        _MERGERS[model_path] = PairMerger(model_path)
    return _MERGERS[model_path]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    `model_path` names a sentencepiece BPE model that lies at the same place on
    every executor.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(model_path)
        for b in chunks(batches):
            n = [m.text(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["id", "n_tokens"])

    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField("id", StructType([StructField("id", id_type), StructField("n_bytes", LongType())])), StructField("n_tokens", LongType())])
    text = F.col(text_col).cast("string")
    source = docs.select(F.struct(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")).alias("id"), text.alias("text"))
    out = source.mapInArrow(count, schema)
    return out.select(F.col("id.id").alias(id_col), F.col("id.n_bytes").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
