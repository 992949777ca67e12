"""SentencePiece encoding and decoding for merge-type vocabularies.

A segment's characters are linked symbols; every adjacent pair whose joint text is a piece waits in
an agenda ordered by the piece's score, then by position. The best pair is merged, its new
neighbours are queued, pairs that have gone stale are skipped. Symbols that are no
piece fall back to bytes. No piece goes on past a space mark that follows other text, so a text is
encoded segment by segment and repeated segments come from a bounded cache. In every Arrow
batch, all segments encoded anew are checked against the sentencepiece library, and the
ids of each text are decoded by the library.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Segments of up to this many characters are kept, up to so many of them in a task.
CACHED_CHARS, CACHED = 64, 600_000
#: Characters of segments given to the library at once.
CHECK_CHARS = 1 << 20
#: Rows of a batch; texts are whole, so a batch holds as many texts.
BATCH_TEXTS = 64

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")


class Pieces:
    """A merge-type vocabulary, its agenda encoder, and the library as its check."""

    def __init__(self, model: str):
        import sentencepiece

        self.lib = lib = sentencepiece.SentencePieceProcessor(model_file=model)
        self.score, self.ids = {}, {}
        for i in range(lib.vocab_size()):
            if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i):
                continue
            if lib.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not covered")
            p = lib.id_to_piece(i)
            if MARK in p.lstrip(MARK):
                raise ValueError(f"piece {p!r} goes on past a space mark")
            self.ids[p], self.score[p] = i, lib.get_score(i)
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if lib.unk_id() in self.bytes:
            raise ValueError("the vocabulary has no byte pieces")
        #: Neighbours that some piece holds; no piece, and so no merge, goes over any other two.
        self.inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.cache: dict[str, tuple[int, ...]] = {}
        self.fresh: list[str] = []
        self.fresh_ids: list[tuple[int, ...]] = []
        self.fresh_chars = 0

    def agenda(self, segment: str) -> tuple[int, ...]:
        """Ids of one segment: merge the best adjacent pair until none is left."""
        if segment in self.ids and len(segment) == 1:
            return (self.ids[segment],)
        score, n = self.score, len(segment)
        text = list(segment)
        prev, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            s = score.get(pair := text[i] + text[i + 1])
            if s is not None:
                queue.append((-s, i, i + 1, pair))
        heapq.heapify(queue)
        while queue:
            _, a, b, pair = heapq.heappop(queue)
            if text[a] is None or text[b] is None or after[a] != b or text[a] + text[b] != pair:
                continue
            text[a], text[b] = pair, None
            after[a] = c = after[b]
            if c >= 0:
                prev[c] = a
                s = score.get(joint := pair + text[c])
                if s is not None:
                    heapq.heappush(queue, (-s, a, c, joint))
            if (p := prev[a]) >= 0:
                s = score.get(joint := text[p] + pair)
                if s is not None:
                    heapq.heappush(queue, (-s, p, a, joint))
        out = []
        for t in text:
            if t is None:
                continue
            if (i := self.ids.get(t)) is not None:
                out.append(i)
            else:
                out.extend(self.bytes[x] for x in t.encode())
        return tuple(out)

    def parts(self, segment: str) -> list[str]:
        """The segment, cut where no piece goes on: a word and the punctuation and line ends after it."""
        inside, out, lo = self.inside, [], 0
        for i in range(1, len(segment)):
            if segment[i - 1:i + 1] not in inside:
                out.append(segment[lo:i])
                lo = i
        out.append(segment[lo:])
        return out

    def segment_ids(self, segment: str) -> tuple[int, ...]:
        if segment[1:].isalpha() or len(parts := self.parts(segment)) == 1:
            ids = self.agenda(segment)
        else:
            ids = ()
            for p in parts:
                known = self.cache.get(p)
                if known is None:
                    known = self.agenda(p)
                    if len(p) <= CACHED_CHARS and len(self.cache) < CACHED:
                        self.cache[p] = known
                ids += known
        self.fresh.append(segment)
        self.fresh_ids.append(ids)
        self.fresh_chars += len(segment)
        if self.fresh_chars >= CHECK_CHARS:
            self.check()
        if len(segment) <= CACHED_CHARS:
            if len(self.cache) >= CACHED:
                self.cache.clear()
            self.cache[segment] = ids
        return ids

    def check(self) -> None:
        """Compare all segments encoded since the last check with the library."""
        # the library puts a space mark in front of every text
        theirs = self.lib.encode([s[1:] for s in self.fresh], num_threads=1)
        for s, a, b in zip(self.fresh, self.fresh_ids, theirs, strict=True):
            if list(a) != b and s != MARK:
                raise ValueError(f"ids of {s!r} differ from the library: {a} / {b}")
        self.fresh, self.fresh_ids, self.fresh_chars = [], [], 0

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        get = self.cache.get
        for s in _SEGMENT.findall(MARK + text.replace(" ", MARK)):
            ids = get(s)
            out += ids if ids is not None else self.segment_ids(s)
        return out

    def decode(self, ids: list[int]) -> str:
        return self.lib.decode(ids)


def _digests(model: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        names = [str(i) for i in range(pieces.lib.vocab_size())]
        for b in batches:
            rows = []
            for at in range(0, b.num_rows, BATCH_TEXTS):
                part = b.slice(at, BATCH_TEXTS)
                known = [pieces.encode(text) for text in part.column(1).to_pylist()]
                for doc, ids, text in zip(part.column(0).to_pylist(), known, pieces.lib.decode(known), strict=True):
                    rows.append((doc, len(ids), hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest(),
                                 hashlib.sha256(text.encode()).hexdigest()))
            pieces.check()
            if rows:
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2]), pa.array(c[3])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode_digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, number of ids, digest of the ids and of the decoded text for each row of ``docs``.

    Null and empty texts have no ids. Very long segments go through the agenda in
    n log n and are not cached. Repeated rows and ids are encoded row by row, other columns are not
    read, an empty table gives an empty result.
    """
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_digests(model), SCHEMA)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """All columns of ``docs`` and ``token_ids``, the ids of ``text``; a column of that name is replaced.

    Null and empty texts have an empty list.
    """
    from pyspark.sql import types as T

    rest = docs.drop("token_ids")
    schema = T.StructType([*rest.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for b in batches:
            for at in range(0, b.num_rows, BATCH_TEXTS):
                part = b.slice(at, BATCH_TEXTS)
                ids = [pieces.encode(t or "") for t in part.column("text").to_pylist()]
                pieces.check()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))],
                                                 names=[*part.schema.names, "token_ids"])
    return rest.mapInArrow(run, schema)
