"""Byte-pair encoding and decoding with the vocabulary file of a public tokenizer.

Files of one kind are read: byte-level BPE with an end-of-word suffix, words cut by
a pattern, white space dropped, lower case. A file that asks for anything else is
refused. Texts become words; the distinct words that a worker has not met yet are
merged together, in rounds over one flat array (``Bpe.merge_words``).

Defined results: a null or empty text has no ids; no ids decode to an empty text; the
strings of special tokens in a text become their ids; ids outside the vocabulary
decode to nothing. Repeated rows give repeated results. Columns other than those named are
not read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from anemos.llm.textarrays import mix, span_sums

#: Characters of text encoded together; slots of a worker's table of words; ids it holds before it starts anew.
TOGETHER, SLOTS, MOST_IDS = 1 << 18, 1 << 20, 1 << 23
#: The pattern that cuts words in files of this kind (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
OTHER, LETTER, NUMBER, SPACE = range(4)
#: Added to the kind of a letter that has to be lower-cased by the library's own table.
FRESH = 4


@cache
def code_kinds() -> tuple[np.ndarray, dict[int, str]]:
    """What the pattern takes each code point for, and lower-case letters that Python doesn't know yet.

    Libraries differ in their version of Unicode. The one that the file was made for decides.
    """
    codes = np.array([i for i in range(0x110000) if not 0xD800 <= i < 0xE000], dtype=np.uint32)
    every = codes.tobytes().decode("utf-32-le")
    found = np.concatenate([np.arange(*m.span()) for m in regex.finditer(r"[\p{L}\p{N}\p{White_Space}]+", every)])
    likely = codes[found]
    text = likely.tobytes().decode("utf-32-le")
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        pieces = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text)
        for _, (low, high) in pieces:
            kinds[likely[low:high]] = kind
    lower = normalizers.Lowercase().normalize_str
    fresh = [c for c in text if unicodedata.category(c) == "Cn"]
    lowered = {ord(c): lower(c) for c in fresh if lower(c) != c}
    kinds[list(lowered)] += FRESH
    return kinds, lowered


def code_hash(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points."""
    values = codes.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    values ^= values >> np.uint64(31)
    return mix(span_sums(values, starts, ends))


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Bpe:
    """Vocabulary and merges as arrays; small enough to be sent to every worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], {}
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if "pretokenizers" in (spec["pre_tokenizer"] or {}):
            split = spec["pre_tokenizer"]["pretokenizers"][0]
        if (model["type"], kinds, split.get("pattern"), split.get("behavior"), split.get("invert"), spec["decoder"],
                model["unk_token"]) != ("BPE", ["NFC", "Replace", "Lowercase"], {"Regex": PATTERN}, "Removed", True,
                                        None, None):
            raise ValueError(f"{path}: not a lower-case byte-level BPE file with word ends")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.kinds, self.lower = code_kinds()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.size = len(self.tokens)
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.last = np.array([vocab[x + suffix] for x in letters], dtype=np.int64)
        pairs = [(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)[order]

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word begins in it (one entry more than words).

        Each round finds the rank of every neighbouring pair by binary search over the
        sorted pair keys, takes each word's lowest rank and merges its occurrences from
        the left. A pair can't rank below the pair that made its parts, so taking all
        occurrences at once gives what merging one by one gives.
        """
        raw = [w.encode("utf-8") for w in words]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols, word = self.inner[data], np.repeat(np.arange(len(raw)), sizes)
        ends = np.cumsum(sizes)[sizes > 0] - 1
        symbols[ends] = self.last[data[ends]]
        none = len(self.keys)
        at = np.zeros(len(symbols), dtype=np.int64)  # of the pair that begins here: its place among the sorted keys
        ranks = np.full(len(symbols), none)

        def look_up(places: np.ndarray) -> None:
            pairs = symbols[places] * self.size + symbols[places + 1]
            found = np.minimum(np.searchsorted(self.keys, pairs), none - 1)
            hit = (self.keys[found] == pairs) & (word[places] == word[places + 1])
            at[places], ranks[places] = found, np.where(hit, self.ranks[found], none)

        look_up(np.arange(len(symbols) - 1))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            firsts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = np.repeat(np.minimum.reduceat(ranks, firsts), np.diff(firsts, append=len(symbols)))
            finished = lowest == none
            if finished.any():
                done.append((word[finished], symbols[finished]))
            chosen = np.flatnonzero((ranks == lowest) & ~finished)
            keep = ~finished
            if len(chosen):  # of occurrences that overlap, as in "aaa", every second one
                run = np.flatnonzero(np.concatenate(([True], np.diff(chosen) != 1)))
                nth = np.arange(len(chosen)) - np.repeat(run, np.diff(run, append=len(chosen)))
                chosen = chosen[nth % 2 == 0]
                symbols[chosen] = self.merged[at[chosen]]
                ranks[chosen] = none
                keep[chosen + 1] = False
            symbols, word, at, ranks = symbols[keep], word[keep], at[keep], ranks[keep]
            places = (np.cumsum(keep) - 1)[chosen]
            places = np.concatenate((places, places - 1))
            look_up(places[(places >= 0) & (places < len(symbols) - 1)])
        if not done:
            return symbols, np.zeros(len(raw) + 1, dtype=np.int64)
        word, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.searchsorted(word[order], np.arange(len(raw) + 1))


class Encoder:
    """Encodes texts and remembers the ids of words in a table of fixed size.

    Words are spans of one array of code points and are known by a 64-bit hash. A word
    whose slot of the table holds another word is merged anew.
    """

    def __init__(self, bpe: Bpe, slots: int = SLOTS):
        self.bpe, self.slots = bpe, slots
        self.cut = regex.compile("(" + "|".join(map(regex.escape, bpe.special)) + ")").split if bpe.special else None
        self._forget()

    def _forget(self) -> None:
        # An empty slot holds a hash that belongs into another one.
        self.known = (np.arange(self.slots, dtype=np.uint64) + np.uint64(1)) % np.uint64(self.slots)
        self.at, self.count = np.zeros(self.slots, dtype=np.int64), np.zeros(self.slots, dtype=np.int32)
        self.ids, self.used = np.zeros(1 << 16, dtype=np.int32), 0

    def _spans(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words start and end, by the pattern that the constructor of Bpe has checked."""
        kind = self.bpe.kinds[codes]
        before = np.concatenate(([SPACE], kind[:-1])).astype(np.uint8)
        start = (kind != SPACE) & ((kind != before) | (kind == NUMBER))
        # An apostrophe that begins a run of other signs takes the letters of a short form with it.
        for i in np.flatnonzero((codes == ord("'")) & start):
            tail = "".join(map(chr, codes[i + 1:i + 3]))
            taken = 1 if tail[:1] in ("s", "t", "m", "d") else 2 if tail in ("re", "ve", "ll") else 0
            if taken:
                start[i + 1] = False
                if i + 1 + taken < len(codes) and kind[i + 1 + taken] == LETTER:
                    start[i + 1 + taken] = True
        edges = np.flatnonzero(start | ((kind == SPACE) & (before != SPACE)))
        own = np.flatnonzero(start[edges])
        return edges[own], np.append(edges, len(codes))[own + 1]

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and each text's bounds in it."""
        # Lower case is taken letter by letter: a sigma at the end of a word is no exception.
        texts = [t.lower() if "Σ" not in t else "".join(c.lower() for c in t)
                 for t in (unicodedata.normalize("NFC", t) for t in texts)]
        joined = "\n".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if self.bpe.kinds[codes].max(initial=0) > SPACE:  # rare: letters that Python can't lower yet
            joined = joined.translate(self.bpe.lower)
            texts = [t.translate(self.bpe.lower) for t in texts]
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts, ends = self._spans(codes)
        hashes = code_hash(codes, starts, ends)
        slot = (hashes % np.uint64(self.slots)).astype(np.int64)
        at, count = self.at[slot], self.count[slot]
        miss = np.flatnonzero(self.known[slot] != hashes)
        if len(miss):
            new, first, which = np.unique(hashes[miss], return_index=True, return_inverse=True)
            first = miss[first]
            ids, bounds = self.bpe.merge_words(
                [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
            self.ids[self.used:self.used + len(ids)] = ids
            own, sizes = self.used + bounds[:-1], np.diff(bounds).astype(np.int32)
            self.used += len(ids)
            at[miss], count[miss] = own[which], sizes[which]
            self.known[slot[first]], self.at[slot[first]], self.count[slot[first]] = new, own, sizes
        stops = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
        flat = self.ids[np.arange(stops[-1]) + np.repeat(at - stops[:-1], count)]
        if self.used > MOST_IDS:
            self._forget()
        begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        return flat, stops[np.searchsorted(starts, begins)]

    def _special(self, text: str) -> np.ndarray:
        """Ids of a text that holds strings of special tokens; what lies between them is encoded on its own."""
        parts = self.cut(text)
        flat, bounds = self._together(parts[::2])
        plain = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        out = plain[:1]
        for name, ids in zip(parts[1::2], plain[1:], strict=True):
            out += [np.array([self.bpe.special[name]], dtype=np.int32), ids]
        return np.concatenate(out)

    def encode(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts in order, some texts at a time: flat ids and each text's bounds in them."""
        texts, size = [], 0
        for text in column:
            text = text.as_py() or ""
            if self.cut and "<" in text and len(self.cut(text)) > 1:
                if texts:
                    yield self._together(texts)
                ids = self._special(text)
                yield ids, np.array([0, len(ids)])
                texts, size = [], 0
                continue
            texts.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield self._together(texts)
                texts, size = [], 0
        if texts:
            yield self._together(texts)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, bpe: Bpe) -> Encoder:
    """This worker's encoder, which later batches and tasks use again."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(bpe)
    return _ENCODERS[path]


def encode(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``ids`` (array<int>) of each text.

    Ids leave a worker as soon as some texts are encoded, so it never holds those of a whole batch.
    """
    shared = df.sparkSession.sparkContext.broadcast(Bpe(path))  # a vocabulary: some tens of thousands of entries
    own = df.select(*keep, F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = encoder(path, shared.value)
        for batch in batches:
            row = 0
            for flat, bounds in worker.encode(batch.column(len(keep))):
                n = len(bounds) - 1
                ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(row, n) for i in range(len(keep))), ids], names=[*keep, "ids"])
                row += n

    return own.mapInArrow(run, T.StructType([*own.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``text`` of each list of ids. The file names no decoder, so tokens are joined by a space."""
    shared = df.sparkSession.sparkContext.broadcast(Bpe(path).tokens)
    own = df.select(*keep, F.col(ids_col).alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        name, known = tokens.__getitem__, len(tokens)
        for batch in batches:
            column, texts, size, row = batch.column(len(keep)), [], 0, 0
            for at in range(len(column)):
                ids = column[at].values
                ids = ids.to_numpy(zero_copy_only=False) if ids is not None else np.zeros(0, dtype=np.int32)
                if len(ids) and not (ids.min() >= 0 and ids.max() < known):
                    ids = ids[(ids >= 0) & (ids < known)].astype(np.int64)
                texts.append(" ".join(map(name, ids.tolist())))
                size += len(ids)
                if size >= TOGETHER or at == len(column) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(i).slice(row, len(texts)) for i in range(len(keep))), pa.array(texts, pa.string())],
                        names=[*keep, "text"])
                    row, texts, size = at + 1, [], 0

    return own.mapInArrow(run, T.StructType([*own.schema.fields[:-1], T.StructField("text", T.StringType())]))
