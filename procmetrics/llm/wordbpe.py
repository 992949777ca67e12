"""BPE encoding and decoding for vocabularies with word ends, in batched numpy merge rounds.

A batch of texts is cut at white space, and the chunks not met before are cut into words. The bytes of all these words stand
in one flat array of symbols. A round looks up every pair of neighbours within a word by binary search in the sorted
keys of the merge table, takes each word's lowest rank, and merges the places of that pair, from left to right, in
all words at once; a word without a pair is done and leaves the array. Ids of chunks are kept, packed as little-endian 32-bit
numbers, in a bounded cache.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of

#: Chunks of up to this many characters are kept, up to so many of them in a task.
CACHED_CHARS, CACHED = 64, 400_000
#: Bytes of text whose new chunks are merged together; a longer text is handled alone.
CHUNK = 1 << 21

# how ASCII words are cut, case already lowered; all other chunks are cut by the library's own rules
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\s]+", re.ASCII)
# letters that the library keeps as one word and lowers one by one; all are in composed form
_LETTERS = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
# white space but for what Python counts as such and Unicode does not
_SPACE, _NO_SPACE = re.compile(r"[^\S\x1c-\x1f]+"), re.compile(r"[\x1c-\x1f]")
_NO_RANK = np.iinfo(np.int64).max


def byte_names() -> list[str]:
    """The character that stands for each byte: printable Latin-1 itself, all others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    names, spare = [], 0x100
    for b in range(256):
        names.append(chr(b if b in plain else spare))
        spare += b not in plain
    return names


class WordBpe:
    """The vocabulary and merges of a tokenizer file, as arrays."""

    def __init__(self, path: str):
        import tokenizers

        lib = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["continuing_subword_prefix"] or spec["decoder"]:
            raise ValueError("not a byte-level BPE vocabulary with word ends and without a decoder")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.normalize, self.cut = lib.normalizer.normalize_str, lib.pre_tokenizer.pre_tokenize_str
        names = byte_names()
        self.inner = np.array([vocab[c] for c in names], np.int64)
        self.last = np.array([vocab[c + end] for c in names], np.int64)
        self.byte = {c: b for b, c in enumerate(names)}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.size = max(*vocab.values(), *self.special.values(), 0) + 1
        self.tokens = [b""] * self.size
        for t, i in (*vocab.items(), *self.special.items()):
            self.tokens[i] = t.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # equal pairs of a word may go in one round if no merge makes a symbol that an earlier merge takes
        rank, born = np.arange(len(pairs)), np.full(self.size, -1)
        born[made] = rank
        self.at_once = bool((born[left] < rank).all() and (born[right] < rank).all())
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], rank[order], made[order]
        #: Packed ids and decoded text of chunks.
        self.ids: dict[str, bytes] = {}
        self.text: dict[str, bytes] = {}

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of words of ``sizes`` symbols each, fully merged: (symbols, sizes)."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        done_symbols, done_words = [], []
        while len(symbols):
            inside = word[:-1] == word[1:]
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.full(len(symbols), _NO_RANK)
            rank[:-1] = np.where(inside & (self.keys[at] == keys), self.ranks[at], _NO_RANK)
            starts = np.flatnonzero(np.concatenate([[True], ~inside]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff([*starts, len(symbols)]))
            over = lowest == _NO_RANK
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
            hit = (rank == lowest) & ~over
            place = np.arange(len(symbols))
            if self.at_once:
                # in a row of overlapping pairs, every other one from the left
                begins = hit & ~np.concatenate([[False], hit[:-1]])
                row = np.maximum.accumulate(np.where(begins, place, 0))
                hit &= (place - row) % 2 == 0
            else:
                hits = np.flatnonzero(hit)
                hit[hits[1:][word[hits[1:]] == word[hits[:-1]]]] = False
            symbols = symbols.copy()
            symbols[hit] = self.made[at[hit[:-1]]]
            left = ~over
            left[1:] &= ~hit[:-1]
            symbols, word = symbols[left], word[left]
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(sizes))

    def words_of(self, chunk: str) -> list[bytes | int]:
        """What the library makes of a chunk without white space: words as bytes, special tokens as ids."""
        out: list[bytes | int] = []
        for part in self.split_special(chunk) if "<" in chunk and self.split_special else (chunk,):
            if part in self.special:
                out.append(self.special[part])
            elif part.isascii():
                out += [w.encode() for w in _ASCII.findall(part.lower())]
            elif part:
                out += [bytes(self.byte[c] for c in w) for w, _ in self.cut(self.normalize(part))]
        return out

    def learn(self, chunks: Iterable[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Packed ids and decoded text of each of the chunks."""
        whole, cut = {}, {}
        for c in chunks:
            if _LETTERS.fullmatch(c):
                whole[c] = c.lower().encode()
            else:
                cut[c] = self.words_of(c)
        words = list({*whole.values(), *(w for ws in cut.values() for w in ws if not isinstance(w, int))})
        ids: dict[bytes | int, bytes] = {i: i.to_bytes(4, "little") for i in self.special.values()}
        text: dict[bytes | int, bytes] = {i: self.tokens[i] for i in self.special.values()}
        if words:
            sizes = np.array([len(w) for w in words], np.int64)
            raw = np.frombuffer(b"".join(words), np.uint8)
            symbols = self.inner[raw]
            ends = np.cumsum(sizes)
            symbols[ends - 1] = self.last[raw[ends - 1]]
            symbols, sizes = self.merged(symbols, sizes)
            packed, tokens = symbols.astype("<u4").tobytes(), [self.tokens[i] for i in symbols.tolist()]
            hi = np.cumsum(sizes)
            for w, a, b in zip(words, (hi - sizes).tolist(), hi.tolist(), strict=True):
                ids[w], text[w] = packed[4 * a:4 * b], b" ".join(tokens[a:b])
        out_ids, out_text = {c: ids[w] for c, w in whole.items()}, {c: text[w] for c, w in whole.items()}
        for c, ws in cut.items():
            out_ids[c], out_text[c] = b"".join([ids[w] for w in ws]), b" ".join([text[w] for w in ws])
        return out_ids, out_text

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids and decoded text of each text."""
        chunks = [[c for c in _SPACE.split(t) if c] if _NO_SPACE.search(t) else t.split() for t in texts]
        fresh = set().union(*chunks).difference(self.ids)
        ids, text = self.ids, self.text
        if fresh:
            new_ids, new_text = self.learn(fresh)
            if len(ids) + len(fresh) > CACHED:
                # what is kept starts anew with the chunks of this batch
                ids, text = ids | new_ids, text | new_text
                short = [c for c in fresh if len(c) <= CACHED_CHARS] if len(fresh) <= CACHED else []
                self.ids, self.text = {c: new_ids[c] for c in short}, {c: new_text[c] for c in short}
            else:
                ids.update(new_ids)
                text.update(new_text)
        out = [(b"".join(map(ids.__getitem__, cs)), b" ".join(filter(None, map(text.__getitem__, cs)))) for cs in chunks]
        if ids is self.ids:
            for c in [c for c in fresh if len(c) > CACHED_CHARS]:
                del ids[c], text[c]
        return out

    def decode(self, packed: bytes) -> str:
        return b" ".join([self.tokens[i] for i in np.frombuffer(packed, "<u4")]).decode()


def _encoded(path: str, column: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(path)
        for b in batches:
            sizes = pa.compute.binary_length(b.column(column)).to_numpy(zero_copy_only=False)
            chunk = np.cumsum(sizes.astype(np.int64)) // CHUNK
            for at in np.split(np.arange(b.num_rows), np.flatnonzero(np.diff(chunk)) + 1):
                if not len(at):
                    continue
                part = b.slice(at[0], len(at))
                done = bpe.encode_batch(part.column(column).to_pylist())
                rest = [part.column(i) for i in range(part.num_columns) if i != column]
                names = [n for i, n in enumerate(part.schema.names) if i != column]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array([i for i, _ in done], pa.binary()), pa.array([d for _, d in done], pa.binary()).cast(pa.string())],
                    names=[*names, "token_ids", "decoded"])
    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs``, with token_ids (little-endian 32-bit numbers in one binary) and decoded, what they decode to.

    Null and empty texts have no ids and decode to an empty text. Ids and decoded text are those of the tokenizers
    library without special tokens added; strings of special tokens in a text are those tokens. Whole texts are
    taken: a very long word goes through the same rounds and is not cached. Every row is encoded by itself, so repeated rows
    and ids give a row each; columns named token_ids or decoded are replaced; an empty table gives an empty result.
    """
    rest = docs.drop("token_ids", "decoded")
    whole = rest.select("*", text_of().alias("_whole"))
    schema = T.StructType([*rest.schema.fields, T.StructField("token_ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    return whole.mapInArrow(_encoded(path, len(rest.columns)), schema)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and digests of the packed ids and of the decoded text."""
    return encoded.select(
        "doc_id", F.floor(F.length("token_ids") / 4).alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
