"""Byte-level BPE by backtracking over longest token matches, and decoding by an offset table."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from hashlib import sha256
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from marketstrata.llm.common import text_batches

#: Signs whose class is the same in every Unicode version; texts with others are split by the library's splitter.
_SETTLED = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ‐-‧‰-⁞]*")


def _kinds(first: str) -> str:
    """The settled signs above ASCII whose Unicode category begins with ``first``, as part of a character class."""
    return "".join(c for c in map(chr, range(0xA1, 0x250)) if unicodedata.category(c)[0] == first)


def _split_pattern() -> re.Pattern:
    """The split pattern of byte-level pre-tokenizers (a fixed value), with its letters and numbers spelt out."""
    letter, number = "A-Za-z" + _kinds("L"), "0-9" + _kinds("N")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+")


_PIECES = _split_pattern()

#: Bounds of what a worker remembers. They bound memory only: what is forgotten is computed again.
PIECE_MEMORY = 100_000
PIECE_CHARS = 64
PAIR_MEMORY = 1_000_000
BATCH_BYTES = 2_000_000


def shown_bytes() -> dict[str, int]:
    """The signs by which a byte-level vocabulary file writes bytes."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, the merges that make them, and the tables of both directions.

    Bytes are held as strings of signs 0 to 255. A token whose own bytes would not be merged into it never
    occurs in an encoding and is left out of the matches. Files other than plain byte-level BPE raise
    ``ValueError``.
    """

    def __init__(self, spec: dict):
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        bare = not any(t.get(k) for t in spec.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip"))
        if not (
            model.get("type", "BPE") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and not spec.get("normalizer") and not model.get("dropout")
            and not model.get("ignore_merges") and not model.get("byte_fallback") and bare
        ):
            raise ValueError("not a plain byte-level BPE file")
        byte = shown_bytes()
        raw = lambda t: "".join(chr(byte[c]) for c in t)
        ids = {raw(t): i for t, i in model["vocab"].items() if t not in special}
        if any(chr(b) not in ids for b in range(256)):
            raise ValueError("the file lacks single bytes")
        size = max(chain(ids.values(), special.values())) + 1
        self.ids, self.special = ids, special
        self.length = [0] * size
        for t, i in ids.items():
            self.length[i] = len(t)
        # Of a merged token: when it was merged, and from what. Single bytes were never merged.
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merged: dict[int, int] = {}
        self.size = size
        valid = {ids[chr(b)] for b in range(256)}
        for rank, merge in enumerate(model["merges"]):
            a, b = (ids[raw(t)] for t in (merge.split(" ") if isinstance(merge, str) else merge))
            made = ids["".join(raw(t) for t in (merge.split(" ") if isinstance(merge, str) else merge))]
            if self.rank[made] >= 0:
                raise ValueError("a token has more than one merge")
            self.rank[made], self.left[made], self.right[made] = rank, a, b
            self.merged[a * size + b] = rank
        self.pairs: dict[int, bool] = {}
        for made in sorted((i for i in range(size) if self.rank[i] >= 0), key=self.rank.__getitem__):
            a, b = self.left[made], self.right[made]
            if a in valid and b in valid and self.stay_apart(a, b, self.rank[made]):
                valid.add(made)
        self.whole = {t: (i,) for t, i in ids.items() if i in valid}
        self.shorter = [-1] * size
        self.matches = ahocorasick.Automaton()
        for t, (i,) in self.whole.items():
            self.matches.add_word(t, i)
            self.shorter[i] = next((self.whole[t[:n]][0] for n in range(len(t) - 1, 0, -1) if t[:n] in self.whole), -1)
        self.matches.make_automaton()

    def stay_apart(self, a: int, b: int, limit: int | None = None) -> bool:
        """Whether no merge ever crosses the border between the tokens ``a`` and ``b``.

        Undoes the merges beside the border, the latest first. A merge across it would have come first if it
        ranks before the merge just undone; of equal merges the one on the left comes first.
        """
        limit = len(self.merged) + 1 if limit is None else limit
        while True:
            if self.merged.get(a * self.size + b, limit) < limit:
                return False
            if self.rank[a] > self.rank[b]:
                limit, a = self.rank[a], self.right[a]
            elif self.rank[b] >= 0:
                limit, b = self.rank[b] + 1, self.left[b]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        """The pair-compatibility table, filled as pairs occur."""
        key = a * self.size + b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIR_MEMORY:
                self.pairs.clear()
            found = self.pairs[key] = self.stay_apart(a, b)
        return found

    def encode_piece(self, piece: str) -> Sequence[int]:
        """Ids of one piece. Takes the longest match at each place whose border holds, and steps back at a dead end.

        Every prefix has one valid encoding, so a place proved dead stays dead and work is linear in the length.
        """
        if piece in self.whole:
            return self.whole[piece]
        n, length, shorter, size, known = len(piece), self.length, self.shorter, self.size, self.pairs.get
        longest = [0] * n
        for end, token in self.matches.iter(piece):
            longest[end - length[token] + 1] = token  # later ends overwrite with longer tokens
        dead = set()
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while True:
            end = at + length[token]
            if end not in dead:
                fits = True if last < 0 else known(last * size + token)
                if fits or (fits is None and self.compatible(last, token)):
                    out.append(token)
                    if end == n:
                        return out
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token < 0:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1
                token = shorter[token]

    def offset_table(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' bytes in id order, and where each begins; ids without a token are empty."""
        content = [b""] * self.size
        for t, i in self.ids.items():
            content[i] = t.encode("latin-1")
        for t, i in self.special.items():
            content[i] = t.encode()
        offsets = np.cumsum([0, *map(len, content)])
        return np.frombuffer(b"".join(content), np.uint8), offsets


class Encoder(dict):
    """Texts to ids; remembers the ids of short pieces in two generations, the older of which is forgotten."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.older: dict[str, Sequence[int]] = {}
        self.vocabulary = vocabulary
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.unshown = {ord(c): chr(b) for c, b in shown_bytes().items()}
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def __missing__(self, piece: str) -> Sequence[int]:
        ids = self.older.get(piece) or self.vocabulary.encode_piece(piece.encode().decode("latin-1"))
        if len(piece) <= PIECE_CHARS:
            if len(self) >= PIECE_MEMORY:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _plain(self, text: str) -> Iterable[Sequence[int]]:
        if _SETTLED.fullmatch(text):
            return map(self.__getitem__, _PIECES.findall(text))
        split = self.library.pre_tokenize_str(text)
        return (self.vocabulary.encode_piece(shown.translate(self.unshown)) for shown, _ in split)

    def encode(self, text: str) -> list[int]:
        parts = self.cut.split(text) if self.cut else [text]
        runs = (((self.vocabulary.special[p],),) if k % 2 else self._plain(p) for k, p in enumerate(parts) if p)
        return list(chain.from_iterable(chain.from_iterable(runs)))


_held: dict[str, tuple[Vocabulary, Encoder, tuple[np.ndarray, np.ndarray]]] = {}


def _tables(written: str) -> tuple[Vocabulary, Encoder, tuple[np.ndarray, np.ndarray]]:
    """The tables of a vocabulary, built once per worker; the last one is kept."""
    name = sha256(written.encode()).hexdigest()
    if name not in _held:
        vocabulary = Vocabulary(json.loads(written))
        _held.clear()
        _held[name] = vocabulary, Encoder(vocabulary), vocabulary.offset_table()
    return _held[name]


def read_vocabulary(path: str) -> str:
    """A tokenizer file as text. It is read by the driver and sent with the tasks, so executors need no copy."""
    with open(path, encoding="utf-8") as file:
        written = file.read()
    Vocabulary(json.loads(written))  # a file of another kind fails here and not in the tasks
    return written


def encode_texts(
    docs: DataFrame, vocabulary: str, keep: Sequence[str] = ("doc_id",), text: str = "text", out: str = "ids"
) -> DataFrame:
    """``keep`` columns and ``out``, the token ids of the whole text (array of int), one row per input row.

    The ids are those of the tokenizer the file describes, special tokens in a text included, without its
    post-processing, truncation and padding. NULL and empty texts have no ids. Texts of any length are read
    whole, in time linear in their length. Repeated rows give repeated rows, an empty table an empty one. Equal
    texts have equal ids; nothing is compared between rows, so there are no ties. Columns besides ``keep`` and
    ``text`` are not read, whatever their names; one of ``keep`` called like ``out`` raises ``ValueError``.
    """
    if out in keep:
        raise ValueError(f"column {out} is to be kept and written")
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tables(vocabulary)[1]
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            sizes = pa.compute.binary_length(column).to_numpy(zero_copy_only=False)
            for a, b in text_batches([range(n) for n in sizes.tolist()], BATCH_BYTES):
                found = [np.array(encoder.encode(t), np.int32) for t in column.slice(a, b - a).to_pylist()]
                at = np.cumsum([0, *map(len, found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(found)))
                rest = [c.slice(a, b - a) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*rest, ids], names=[*batch.schema.names[:-1], out])

    shape = ", ".join([f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))] + [f"`{out}` array<int>"])
    found = rows.mapInArrow(run, shape)
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col(out))


def decode_ids(rows: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``rows`` but ``ids``, and ``out``, the text the ids stand for, special tokens included.

    Ids are looked up in one table of offsets. NULL lists give NULL; NULL ids and ids that the vocabulary lacks
    stand for nothing; bytes that are no UTF-8 become the replacement character, as the tokenizer does. Row order
    and number are kept, an empty table stays empty.
    """
    rest = [c for c in rows.columns if c not in (ids, out)]
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(rest)]
    picked = rows.select(*kept, F.col(ids).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob, offsets = _tables(vocabulary)[2]
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            counts = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            for a, b in text_batches([range(8 * n) for n in counts.tolist()], BATCH_BYTES):
                part = column.slice(a, b - a)
                # flatten() leaves NULL lists out, so the counts fit.
                flat = pa.compute.fill_null(part.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = np.where((flat < 0) | (flat >= len(offsets) - 1), len(offsets) - 1, flat)
                starts, ends = offsets[flat], offsets[np.minimum(flat + 1, len(offsets) - 1)]
                sizes = ends - starts
                before = np.concatenate(([0], np.cumsum(sizes)))
                data = blob[np.arange(before[-1]) + np.repeat(starts - before[:-1], sizes)].tobytes()
                cut = before[np.concatenate(([0], np.cumsum(counts[a:b])))]
                texts = [data[x:y].decode("utf-8", "replace") for x, y in zip(cut[:-1], cut[1:], strict=True)]
                decoded = pa.array(texts, pa.string(), mask=part.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*[c.slice(a, b - a) for c in batch.columns[:-1]], decoded], names=[*batch.schema.names[:-1], out])

    shape = ", ".join([f"k{i} {picked.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(rest))] + [f"`{out}` string"])
    found = picked.mapInArrow(run, shape)
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(rest)], F.col(out))
