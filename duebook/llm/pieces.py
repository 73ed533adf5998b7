"""SentencePiece encoding of merge-type models by a prefix table.

The model merges, of all neighbouring symbols whose concatenation is a piece, those of the best score first (leftmost if
equal). Whatever follows a prefix, the merges inside the prefix come in the same order, so a prefix has one encoding of its
own and hence one last token. The table stores that token for each prefix: an automaton names the pieces that end there, and
the right one is the piece whose predecessor's last token it is compatible with, that is, which stay apart when the two are
encoded together. Reading the table backwards from the end of a text gives the ids.

Where no piece holds two neighbouring characters side by side nothing ever merges, so a text falls into words there; each
distinct word of a block is looked up once. Characters without a piece become their bytes' ids.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from duebook.llm.bpe import gather
from duebook.llm.common import BLOCK_BYTES, text_blocks

#: Fixed values of the model format.
BLANK = "▁"
MERGE_TYPE = 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Words kept between blocks, the longest one that is kept, and tested pairs kept; beyond that a store begins anew.
STORE_WORDS, STORE_LENGTH, STORE_PAIRS = 400_000, 64, 300_000
NEVER = float("-inf")
#: Added to the code point of a character without a piece where an id is kept; above all code points.
NO_PIECE = 1 << 21
#: Code points below this are looked up in a square.
LOW = 1024


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class PieceEncoder:
    """A merge-type model file, with byte fallback and no normalisation beside its blanks."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(fields(file.read()))
        trainer, normalizer = (dict(fields(b"".join(v for n, v in parts if n == k))) for k in (2, 3))
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        for n, value in parts:
            if n == 1:
                piece = dict(fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(piece.get(3, NORMAL))
        self.dummy_prefix = bool(normalizer.get(3, 1))
        plain = not normalizer.get(2) and not normalizer.get(4, 1) and normalizer.get(5, 1)
        if trainer.get(3) != MERGE_TYPE or not plain or USER_DEFINED in self.kinds or UNUSED in self.kinds or self.kinds.count(BYTE) != 256:
            raise ValueError(f"{path}: only merge-type models with byte fallback and without normalisation rules")
        self.end_id = trainer.get(42, 2)
        self.unknown_surface = trainer.get(44, " ⁇ ".encode())
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.scores = {p: scores[i] for p, i in self.ids.items()}
        self.byte_ids = [i for i, k in enumerate(self.kinds) if k == BYTE]
        if not self.ids.keys() >= set("".join(self.ids)):
            raise ValueError(f"{path}: a piece holds a character that is no piece itself")
        self._neighbours()
        self.automaton = ahocorasick.Automaton()
        self.alone = {p: self.merges(p) for p in self.ids}
        for p, (*_, whole) in self.alone.items():
            # A piece that its own characters do not merge to never is a token.
            if whole:
                self.automaton.add_word(p, self.ids[p])
        self.automaton.make_automaton()
        spelled = []
        for p, k in zip(self.pieces, self.kinds):
            plain_text = {CONTROL: b"", UNKNOWN: self.unknown_surface}.get(k, p.replace(BLANK, " ").encode())
            spelled.append(bytes([int(p[3:5], 16)]) if k == BYTE else plain_text)
        self.sizes = [len(p) for p in self.pieces]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.concatenate([[0], np.cumsum([len(s) for s in spelled])]).astype(np.int64)
        self.kind_of = np.array(self.kinds, np.int8)
        self.blank_first = np.array([k == NORMAL and p.startswith(BLANK) for p, k in zip(self.pieces, self.kinds)])
        self.forget()

    def forget(self) -> None:
        self.store: dict[str, list[int]] = {}
        self.apart: dict[int, bool] = {}

    def _neighbours(self) -> None:
        """The pairs of characters that stand side by side in a piece; those of low code points as a square."""
        pairs = np.array(sorted({ord(a) << 32 | ord(b) for p in self.ids for a, b in zip(p, p[1:])}), np.uint64)
        self.pairs = np.append(pairs, np.uint64((1 << 64) - 1))
        a, b = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        low = (a < LOW) & (b < LOW)
        self.low_pairs = np.zeros(LOW * LOW, bool)
        self.low_pairs[a[low] * LOW + b[low]] = True

    def word_starts(self, points: np.ndarray) -> np.ndarray:
        """Where a character may not merge with the one before it."""
        left, right = points[:-1].astype(np.int64), points[1:].astype(np.int64)
        low = (left < LOW) & (right < LOW)
        joined = self.low_pairs[np.where(low, left * LOW + right, 0)]
        high = np.flatnonzero(~low)
        keys = (left[high].astype(np.uint64) << np.uint64(32)) | right[high].astype(np.uint64)
        joined[high] = self.pairs[np.searchsorted(self.pairs, keys)] == keys
        return np.append(True, ~joined)

    def merges(self, text: str) -> tuple[list[float], list[str], list[str], bool]:
        """How a short text merges by itself.

        The scores in their order, the last and the first symbol before each merge and in the end, and if one symbol is left.
        """
        symbols, scores = list(text), self.scores
        done, last, first = [], [symbols[-1]], [symbols[0]]
        while len(symbols) > 1:
            best = max(((s, -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (s := scores.get(a + b)) is not None), default=None)
            if best is None:
                break
            at = -best[1]
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            done.append(best[0])
            last.append(symbols[-1])
            first.append(symbols[0])
        return done, last, first, len(symbols) == 1

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens stay what they are when they stand side by side.

        Until a merge crosses the border, each side merges as it does alone, and the better of their next ones comes first.
        """
        left_scores, last, *_ = self.alone.get(left) or self.merges(left)
        right_scores, _, first, _ = self.alone.get(right) or self.merges(right)
        i = j = 0
        n, m, scores = len(left_scores), len(right_scores), self.scores
        while True:
            crossing = scores.get(last[i] + first[j])
            one, other = left_scores[i] if i < n else NEVER, right_scores[j] if j < m else NEVER
            # Of equal scores the leftmost merge comes first: one of the left side, then the crossing one.
            if crossing is not None and crossing > one and crossing >= other:
                return False
            if i == n and j == m:
                return True
            if one >= other and i < n:
                i += 1
            else:
                j += 1

    def last_tokens(self, word: str) -> list[int]:
        """For each prefix of the word, the id of its encoding's last token; for a character without a piece, its code point
        less 2 ** 21."""
        last: list[int] = []
        done, sizes, apart = 0, self.sizes, self.apart
        for end, id in self.automaton.iter(word):
            if end < done:
                continue
            while done < end:
                last.append(ord(word[done]) - NO_PIECE)
                done += 1
            before = end - sizes[id]
            if before >= 0:
                key = last[before] << 21 | id
                known = apart.get(key)
                if known is None:
                    known = self._tested(key, last[before], id)
                if not known:
                    continue
            last.append(id)
            done += 1
        return last + [ord(c) - NO_PIECE for c in word[done:]]

    def _tested(self, key: int, left: int, right: int) -> bool:
        if len(self.apart) >= STORE_PAIRS:
            self.apart.clear()
        before = self.pieces[left] if left >= 0 else chr(left + NO_PIECE)
        known = self.apart[key] = self.compatible(before, self.pieces[right])
        return known

    def word_ids(self, word: str) -> list[int]:
        """The word's ids, read backwards from the table."""
        last, at, found = self.last_tokens(word), len(word), []
        while at:
            id = last[at - 1]
            if id >= 0:
                found.append(id)
                at -= self.sizes[id]
            else:
                found += [self.byte_ids[b] for b in reversed(chr(id + NO_PIECE).encode())]
                at -= 1
        found.reverse()
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as UTF-8 end to end, each with the end id, and the texts' bounds among them."""
        whole, at = data.tobytes(), offsets.tolist()
        texts = [whole[a:b].decode() for a, b in zip(at, at[1:])]
        prefix = BLANK if self.dummy_prefix else ""
        texts = [prefix + t.replace(" ", BLANK) if t else "" for t in texts]
        joined = "".join(texts)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if not joined:
            return np.full(len(texts), self.end_id, np.int32), np.arange(len(texts) + 1)
        starts = self.word_starts(np.frombuffer(joined.encode("utf-32-le"), np.uint32))
        starts[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        start = np.flatnonzero(starts)
        raw = np.frombuffer(joined.encode(), np.uint8)
        begins = np.flatnonzero((raw & 0xC0) != 0x80)
        cuts = np.append(begins[start], len(raw))
        words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(cuts), pa.py_buffer(raw)]).dictionary_encode()
        distinct, which = words.dictionary.to_pylist(), words.indices.to_numpy()
        found: list[list[int]] = []
        for word in distinct:
            ids = self.store.get(word)
            if ids is None:
                ids = self.word_ids(word)
                if len(word) <= STORE_LENGTH:
                    if len(self.store) >= STORE_WORDS:
                        self.store.clear()
                    self.store[word] = ids
            found.append(ids)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        pool = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        pool_at = np.cumsum(sizes) - sizes
        ids = gather(pool, pool_at[which], sizes[which])
        upto = np.concatenate([[0], np.cumsum(sizes[which])])[np.searchsorted(start, bounds)]
        return np.insert(ids, upto[1:], np.int32(self.end_id)), upto + np.arange(len(upto))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Texts of the ids; control ids spell nothing, the blank that encoding puts in front goes, and runs of bytes that are
        no UTF-8 become a replacement character each."""
        size = np.diff(self.spelled_at)[ids]
        spelled = gather(self.spelled, self.spelled_at[ids], size).tobytes()
        at = np.concatenate([[0], np.cumsum(size)])[bounds].tolist()
        texts = []
        for n, (a, b) in enumerate(zip(at, at[1:])):
            own = ids[bounds[n] : bounds[n + 1]]
            text = spelled[a:b]
            kinds = self.kind_of[own]
            if (kinds == BYTE).any():
                try:
                    text.decode()
                    if (kinds[:-1] == CONTROL).any():
                        text = self._decode_slowly(own)
                except UnicodeDecodeError:
                    text = self._decode_slowly(own)
            first = own[kinds != CONTROL][:1]
            if self.dummy_prefix and len(first) and self.blank_first[first[0]]:
                text = text[1:]
            texts.append(text)
        return texts

    def _decode_slowly(self, ids: np.ndarray) -> bytes:
        out, run = [], b""
        for id in [*ids.tolist(), None]:
            spelled = b"" if id is None else self.spelled[self.spelled_at[id] : self.spelled_at[id + 1]].tobytes()
            if id is not None and self.kinds[id] == BYTE:
                run += spelled
                continue
            while run:
                for size in range(min(4, len(run)), 0, -1):
                    try:
                        if len(run[:size].decode()) == 1:
                            out.append(run[:size])
                            break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�".encode())
                run = run[size:]
            out.append(spelled)
        return b"".join(out)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The model of a file, read once per Python process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode_texts(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decode: bool = False) -> DataFrame:
    """Columns `keep`, `ids` (array of int, the end id last) and, if asked for, `decoded`, the text the ids spell.

    Null and empty texts have the end id alone and decode to an empty text. A literal blank sign of the model's decodes to a
    blank, as the model has it. Equal rows stay separate rows. Columns of the input that are not in `keep` are dropped, so
    names cannot clash; `keep` must not hold `ids` or `decoded`.
    """
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    added += [T.StructField("decoded", T.StringType(), False)] * decode
    source = df.select(*[df[f"`{c}`"] for c in keep], df[f"`{text}`"].alias("_text"))
    schema = T.StructType(source.schema.fields[:-1] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        for batch in batches:
            done = 0
            for data, offsets in text_blocks(batch.column(len(keep)), BLOCK_BYTES):
                n = len(offsets) - 1
                ids, bounds = model.encode(data, offsets)
                columns = [batch.column(i).slice(done, n) for i in range(len(keep))]
                columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())))
                if decode:
                    columns.append(pa.array(model.decode(ids, bounds), pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                done += n
        # Python workers live on after a task; the words it met need not.
        model.forget()

    return source.mapInArrow(run, schema)


def decode_ids(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and `decoded`; null ids give an empty text."""
    source = df.select(*[df[f"`{c}`"] for c in keep], df[f"`{ids}`"].alias("_ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        for batch in batches:
            lists = batch.column(len(keep))
            sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = model.decode(flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)
