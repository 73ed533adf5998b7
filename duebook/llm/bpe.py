"""Byte-pair encoding and decoding in batched merge rounds.

Texts are cut into words on whole arrays of code points. Each distinct word of a block is encoded once: the symbols of
all such words lie end to end in one array; a round looks up the ranks of new pairs by binary search in the sorted pair
keys of the vocabulary, takes each word's lowest rank, and merges that pair wherever it stands in the word. Merging all
places of a pair at once equals merging one by one, as a pair that holds a new symbol always has a higher rank.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from duebook.llm.common import BLOCK_BYTES, text_blocks

SPACE, LETTER, NUMBER, OTHER = range(4)
NO_PAIR = np.iinfo(np.int32).max
#: Code points with the Unicode property White_Space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Words kept encoded between blocks; beyond that the store begins anew.
STORE_WORDS = 600_000


#: Letters and digits that the tokenizers' tables of Unicode have and this Python's may not, as ranges, and the
#: lower case of those among them that have one.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CE), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_DIGITS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
NEW_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}


def code_point_classes() -> np.ndarray:
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        first = unicodedata.category(chr(c))[0]
        if first in "LN":
            kinds[c] = LETTER if first == "L" else NUMBER
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_DIGITS, NUMBER)):
        for first, last in ranges:
            kinds[first : last + 1] = kind
    kinds[WHITE] = SPACE
    return kinds


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def word_starts(points: np.ndarray, kind: np.ndarray, first: np.ndarray, attach: bool) -> np.ndarray:
    """Where words begin. first: where texts begin. attach: a blank goes with what follows, and digits stay together.

    Without attach, each digit is a word and white space (which the caller drops) stands by itself.
    """
    n = len(points)
    before = np.empty(n, np.uint8)
    before[1:] = kind[:-1]
    begins = first.copy()
    begins[1:] |= kind[1:] != before[1:]
    last = np.empty(n, bool)
    last[-1:] = True
    last[:-1] = first[1:]
    blank_before = np.zeros(n, bool)
    if attach:
        blank_before[1:] = (points[:-1] == 32) & ~first[1:]
        starts = begins & ~((kind != SPACE) & blank_before)
        ends_white = np.zeros(n, bool)
        ends_white[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~last[:-1]
        starts |= ends_white
    else:
        starts = begins | (kind == NUMBER)
    # An apostrophe that begins a word takes a clitic of one or two letters with it.
    quote = np.flatnonzero((points == 39) & begins & ~blank_before & ~last)
    quote = quote[kind[quote + 1] == LETTER]
    if len(quote):
        one, two = points[quote + 1], np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
        two = np.where(last[quote + 1], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for at, length in ((quote[short], 2), (quote[pair & ~short], 3)):
            starts[at + 1] = False
            after = at + length
            after = after[after < n]
            starts[after] = True
    return starts


@dataclass
class Encoder:
    """A byte-level BPE vocabulary of a tokenizer file, with its normalisation and words."""

    path: str
    normalise: bool = field(init=False)
    attach: bool = field(init=False)

    def __post_init__(self):
        with open(self.path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.normalise = spec["normalizer"] is not None
        self.attach = not self.suffix
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 16) | vocab[b] for a, b in pairs], np.uint32)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        shown = byte_characters()
        self.byte_ids = np.array([vocab[c] for c in shown], np.int32)
        self.last_ids = np.array([vocab[c + self.suffix] for c in shown], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.kinds = code_point_classes()
        self.byte_level = spec["decoder"] is not None
        self._token_bytes({v: k for k, v in vocab.items()}, {c: b for b, c in enumerate(shown)})
        self.forget()

    def _token_bytes(self, tokens: dict[int, str], byte_of: dict[str, int]) -> None:
        added = {i: s for s, i in self.special.items()}
        spelled = []
        for i in range(max([*tokens, *added]) + 1):
            if i in added:
                spelled.append(added[i].encode())
            elif self.byte_level:
                spelled.append(bytes(byte_of[c] for c in tokens.get(i, "")))
            else:
                spelled.append(tokens.get(i, "").encode() + b" ")
        if not self.byte_level:
            spelled = [s if s.endswith(b" ") else s + b" " for s in spelled]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.concatenate([[0], np.cumsum([len(s) for s in spelled])]).astype(np.int64)

    # ---- words ------------------------------------------------------------------------------------------------

    def forget(self) -> None:
        self.store: dict[bytes, int] = {}
        self.pool_at = np.empty(0, np.int64)
        self.pool_len = np.empty(0, np.int64)
        self.pool = np.empty(0, np.int32)

    def _words(self, data: np.ndarray, points: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The words as Arrow bytes, where each starts, and which of them count. bounds: where the texts begin and end."""
        first = np.zeros(len(points), bool)
        first[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        kind = self.kinds[points]
        start = np.flatnonzero(word_starts(points, kind, first, self.attach))
        begins = np.flatnonzero((data & 0xC0) != 0x80)
        at = np.append(begins[start], len(data))
        words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(data)])
        return words, start, (kind[start] != SPACE) | self.attach

    def _encode_points(self, data: np.ndarray, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the texts' bounds among them."""
        if not len(points):
            return np.empty(0, np.int32), np.zeros(len(bounds), np.int64)
        words, start, counts = self._words(data, points, bounds)
        coded = words.dictionary_encode()
        which, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        if not all(map(self.store.__contains__, distinct)):
            if len(self.store) + len(distinct) > STORE_WORDS:
                self.forget()
            self._learn([w for w in distinct if w not in self.store])
        slots = np.fromiter(map(self.store.__getitem__, distinct), np.int64, len(distinct))[which]
        length = self.pool_len[slots] * counts
        ids = gather(self.pool, self.pool_at[slots], length)
        upto = np.concatenate([[0], np.cumsum(length)])
        return ids, upto[np.searchsorted(start, bounds)]

    def _learn(self, words: list[bytes]) -> None:
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        ids, id_bounds = self.merge(np.frombuffer(b"".join(words), np.uint8), bounds)
        self.store.update(zip(words, range(len(self.store), len(self.store) + len(words))))
        self.pool_at = np.concatenate([self.pool_at, id_bounds[:-1] + len(self.pool)])
        self.pool_len = np.concatenate([self.pool_len, np.diff(id_bounds)])
        self.pool = np.concatenate([self.pool, ids])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_PAIR).astype(np.int32)

    def merge(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as bytes end to end; no word is empty."""
        n_words = len(bounds) - 1
        symbols = self.byte_ids[data]
        symbols[bounds[1:] - 1] = self.last_ids[data[bounds[1:] - 1]]
        lengths = np.diff(bounds)
        words = np.repeat(np.arange(n_words), lengths)
        ranks = np.full(len(symbols), NO_PAIR, np.int32)
        inner = np.flatnonzero(words[:-1] == words[1:])
        ranks[inner] = self._ranks(symbols[inner], symbols[inner + 1])
        done_words, done_symbols = [], []
        while len(symbols):
            begin = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
            sizes = np.diff(np.append(begin, len(words)))
            lowest = np.repeat(np.minimum.reduceat(ranks, begin), sizes)
            ready = lowest == NO_PAIR
            if ready.any():
                done_words.append(words[ready])
                done_symbols.append(symbols[ready])
                rest = ~ready
                symbols, words, ranks, lowest = symbols[rest], words[rest], ranks[rest], lowest[rest]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == lowest)
            # Of overlapping places (a a a) every second one from the left is merged.
            run = np.append(True, np.diff(at) != 1)
            at = at[(at - at[run][np.cumsum(run) - 1]) % 2 == 0]
            symbols[at] = self.merged[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = at - np.arange(len(at))
            symbols, words, ranks = symbols[keep], words[keep], ranks[keep]
            for here in (place, place[place > 0] - 1):
                inside = here[here + 1 < len(symbols)]
                joined = words[inside] == words[inside + 1]
                ranks[inside[~joined]] = NO_PAIR
                ranks[here[here + 1 >= len(symbols)]] = NO_PAIR
                inside = inside[joined]
                ranks[inside] = self._ranks(symbols[inside], symbols[inside + 1])
        all_words = np.concatenate(done_words) if done_words else np.empty(0, np.int64)
        order = np.argsort(all_words, kind="stable")
        ids = np.concatenate(done_symbols)[order] if done_symbols else np.empty(0, np.int32)
        counts = np.bincount(all_words, minlength=n_words)
        return ids, np.concatenate([[0], np.cumsum(counts)])

    # ---- texts ------------------------------------------------------------------------------------------------

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as UTF-8 end to end, and the texts' bounds among them."""
        whole = data.tobytes()
        special = any(s.encode() in whole for s in self.special)
        if not special and not self.normalise:
            points = np.frombuffer(whole.decode().encode("utf-32-le"), np.uint32)
            counts = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=counts[1:])
            return self._encode_points(data, points, counts[offsets])
        at = offsets.tolist()
        texts = [whole[a:b].decode() for a, b in zip(at, at[1:])]
        if not special:
            return self._encode_texts(texts)
        parts = [self.special_pattern.split(t) for t in texts]
        flat = [p for own in parts for p in own]
        owned = np.concatenate([[0], np.cumsum([len(own) for own in parts])])
        marks = [self.special.get(p) for p in flat]
        ids, bounds = self._encode_texts(["" if m is not None else p for p, m in zip(flat, marks)])
        pieces = [ids[a:b] if m is None else np.array([m], np.int32) for a, b, m in zip(bounds, bounds[1:], marks)]
        upto = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        return np.concatenate(pieces), upto[owned]

    def _encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.normalise:
            # Letter by letter, as the tokenizer does: no other form of sigma at a word's end.
            texts = [unicodedata.normalize("NFC", t).replace("Σ", "σ").lower().translate(NEW_LOWER) for t in texts]
        joined = "".join(texts)
        data, points = np.frombuffer(joined.encode(), np.uint8), np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        return self._encode_points(data, points, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Texts of the ids: the bytes they spell, or the vocabulary's own spelling with blanks between."""
        size = np.diff(self.spelled_at)[ids]
        spelled = gather(self.spelled, self.spelled_at[ids], size).tobytes()
        at = np.concatenate([[0], np.cumsum(size)])[bounds].tolist()
        if self.byte_level:
            return [spelled[a:b].decode(errors="replace").encode() for a, b in zip(at, at[1:])]
        return [spelled[a : max(a, b - 1)] for a, b in zip(at, at[1:])]


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Ranges of an array end to end."""
    total = int(length.sum())
    if not total:
        return values[:0]
    used = length > 0
    start, length = start[used], length[used]
    step = np.ones(total, np.int64)
    step[0] = start[0]
    ends = np.cumsum(length)[:-1]
    step[ends] = start[1:] - (start[:-1] + length[:-1] - 1)
    return values[np.cumsum(step)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The vocabulary of a file, read once per Python process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_texts(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decode: bool = False) -> DataFrame:
    """Columns `keep`, `ids` (array of int) and, if asked for, `decoded`, the text the ids spell.

    Null and empty texts give an empty array and an empty text. Equal rows stay separate rows. Columns of the input that
    are not in `keep` are dropped, so names cannot clash; `keep` must not hold `ids` or `decoded`.
    """
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    added += [T.StructField("decoded", T.StringType(), False)] * decode
    source = df.select(*[df[f"`{c}`"] for c in keep], df[f"`{text}`"].alias("_text"))
    schema = T.StructType(source.schema.fields[:-1] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            done = 0
            for data, offsets in text_blocks(batch.column(len(keep)), 2 * BLOCK_BYTES):
                n = len(offsets) - 1
                ids, bounds = bpe.encode(data, offsets)
                columns = [batch.column(i).slice(done, n) for i in range(len(keep))]
                columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())))
                if decode:
                    columns.append(pa.array(bpe.decode(ids, bounds), pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                done += n
        # Python workers live on after a task; the words it met need not.
        bpe.forget()

    return source.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and `decoded`; null ids give an empty text."""
    source = df.select(*[df[f"`{c}`"] for c in keep], df[f"`{ids}`"].alias("_ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            lists = batch.column(len(keep))
            sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = bpe.decode(flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)
