"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

A text goes through in pieces of any size.  Control strings are cut out first, then the text falls into
words (runs of letters, digits, other signs or white space), then each word's bytes are merged.

*Lookahead.*  Take a word and the same word with more behind it, and apply the merge list to both, rule by
rule.  The place up to which both have the same tokens starts at the end of the shorter word.  A rule
(u, v) moves it back by the length of u at most, and only where v starts there in one of the two, so that v
starts with what the last such rule had on its left.  A chain of such rules has rising ranks; the longest
sum of lengths over all chains, found in one pass over the list, is a lookahead that suffices: a token that
ends that far before the end of what was read never changes again.  Nothing merged across its end, so the
bytes behind it can go on alone.  Memory is constant: the bytes not yet stable, one piece of text, and a
table of short words that starts anew when it is full.

Decoding turns ids into bytes and holds back at most three of them, the start of a code point.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16  # characters given to the transducer at once
LONG = 512  # characters of a word from which its bytes are merged as they come
BLOCK = 4096  # bytes of a long word merged at once, beyond the lookahead
TABLE = 250_000  # short words remembered, beyond those of one part of the texts
LEARNED = 32  # bytes of the words that are worked out together
ROWS = 1 << 14  # words worked out together
PART = 4 << 20  # bytes of text whose words are worked out together

# fixed values: the words of this kind of tokenizer
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?{O}+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Vocabulary:
    """Tables of a tokenizer: ``pairs`` maps left << 32 | right to the rank, ``made`` a rank to the id."""

    pairs: dict[int, int]
    made: list[int]
    single: list[int]  # id of each byte
    bytes_of: dict[int, bytes]
    special: dict[str, int]
    unlike: str  # ranges of characters that this tokenizer doesn't count as letters or digits

    @property
    def lookahead(self) -> int:
        return sufficient_lookahead(self)


def _byte_names() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def read_vocabulary(path: str) -> Vocabulary:
    """The tables in a ``tokenizer.json`` with a byte-level BPE model.

    A file with other parts (normalizer, prefix spaces, affixes, dropout, rules before those that make
    their sides) is refused, as the lookahead and the words hold for the plain kind only.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, before = content["model"], content["pre_tokenizer"] or {}
    odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
    if model.get("ignore_merges") or content["normalizer"] or before.get("add_prefix_space") or odd:
        raise ValueError("not a plain byte-level BPE")
    if before.get("type") != "ByteLevel" or not before.get("use_regex", True):
        raise ValueError("words are not those of byte-level BPE")
    added = content.get("added_tokens", [])
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
        raise ValueError("control strings that take in their surroundings")
    names, ids = _byte_names(), model["vocab"]
    pairs, made, known = {}, [], {ids[c] for c in names if c in ids}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        a, b, ab = ids[left], ids[right], ids[left + right]
        if a not in known or b not in known or ab in known:
            raise ValueError(f"rule {rank} comes before its sides, or makes a token again")
        known.add(ab)
        pairs[a << 32 | b] = rank
        made.append(ab)
    bytes_of = {i: bytes(names[c] for c in t) for t, i in ids.items() if set(t) <= names.keys()}
    special = {a["content"]: a["id"] for a in added}
    bytes_of |= {i: t.encode() for t, i in special.items()}
    single = [ids[c] for c, _ in sorted(names.items(), key=lambda x: x[1])]
    return Vocabulary(pairs, made, single, bytes_of, special, _unlike())


@cache
def _unlike() -> str:
    """Ranges of the letters and digits that are newer than the tokenizer's Unicode tables.

    The tokenizer library is asked for its tables, as the pattern module may know a later Unicode.
    """
    from tokenizers import Regex, pre_tokenizers

    text = "".join(c for c in map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    text = "".join(regex.findall(r"[\p{L}\p{N}]", text))
    cut = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True)
    newer = sorted(set(text) - {c for c, _ in cut.pre_tokenize_str(text)})
    ranges: list[list[int]] = []
    for code in map(ord, newer):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def sufficient_lookahead(vocabulary: Vocabulary) -> int:
    """Bytes behind a token's end after which it is stable, whatever follows."""
    length = {i: 1 for i in vocabulary.single}
    left_of: dict[int, int] = {}
    longest: dict[int, int] = {}  # by left side: of the chains that end with a rule of this left side
    for pair, made in zip(vocabulary.pairs, vocabulary.made, strict=True):
        u, v = pair >> 32, pair & 0xFFFFFFFF
        behind, start = 0, v
        while start is not None:
            behind = max(behind, longest.get(start, 0))
            start = left_of.get(start)
        longest[u] = max(longest.get(u, 0), length[u] + behind)
        left_of[made] = u
        length[made] = length[u] + length[v]
    return max(longest.values(), default=0)


class Words(dict):
    """Ids of short words, worked out when first asked for; a full table starts anew."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.rank = vocabulary.pairs.get
        self.made = vocabulary.made
        self.single = vocabulary.single
        self.length_of = {i: len(b) for i, b in vocabulary.bytes_of.items()}
        self.block = vocabulary.lookahead + BLOCK
        self.rest = b""
        pairs = np.array([*vocabulary.pairs, -1])
        self.pair_ranks = np.argsort(pairs)
        self.pairs = pairs[self.pair_ranks]
        self.made_numbers = np.array([*vocabulary.made, -1])
        self.numbers = np.array(vocabulary.single)

    def __missing__(self, word: str) -> tuple[int, ...]:
        data = word.encode()
        if len(data) > BLOCK:
            return (*self.stable(data), *self.merge(self.rest))
        ids = tuple(self.merge(data))
        if len(data) <= LONG:
            if len(self) >= TABLE:
                self.clear()
            self[word] = ids
        return ids

    def learn(self, words: set[str]) -> None:
        """Put unknown short words into the table; those of one length are merged together, as rows."""
        unknown = words.difference(self)
        if len(self) + len(unknown) > TABLE:
            self.clear()
            unknown = words
        by_size: dict[int, list[str]] = defaultdict(list)
        for word in unknown:
            by_size[len(word.encode())].append(word)
        for size, listed in by_size.items():
            if size > LEARNED:
                continue
            for at in range(0, len(listed), ROWS):
                self._learn(listed[at : at + ROWS], size)

    def _learn(self, words: list[str], size: int) -> None:
        names = np.array(words, object)
        ids = self.numbers[np.frombuffer("".join(words).encode(), np.uint8)].reshape(-1, size)
        ranks = self.ranks_of(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1:
            # every row that goes on has one merge less to do, so all of them stay equally long
            at = ranks.argmin(1)
            least = ranks[np.arange(len(at)), at]
            goes_on = least < len(self.made)
            self._put(names[~goes_on], ids[~goes_on])
            names, ids, ranks, at, least = (x[goes_on] for x in (names, ids, ranks, at, least))
            row, column = np.arange(len(at)), np.arange(ids.shape[1] - 1)
            ids[row, at] = self.made_numbers[least]
            ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), 1)
            for beside in (at - 1, at):
                has = np.flatnonzero((beside >= 0) & (beside < ranks.shape[1]))
                place = beside[has]
                ranks[has, place] = self.ranks_of(ids[has, place], ids[has, place + 1])
        self._put(names, ids)

    def _put(self, names: np.ndarray, ids: np.ndarray) -> None:
        self.update(zip(names.tolist(), map(tuple, ids.tolist()), strict=True))

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, beyond all ranks where there is no rule."""
        pairs = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], len(self.made))

    def merge(self, data: bytes) -> list[int]:
        """The ids of bytes that belong together: the least rank first, from the left."""
        ids = [self.single[b] for b in data]
        if len(ids) > 40:
            return self._merge_long(ids)
        rank, made = self.rank, self.made
        ranks = [rank(a << 32 | b, 1 << 60) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == 1 << 60:
                break
            at = ranks.index(least)
            ids[at : at + 2] = [made[least]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(ids[at - 1] << 32 | ids[at], 1 << 60)
            if at < len(ranks):
                ranks[at] = rank(ids[at] << 32 | ids[at + 1], 1 << 60)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of (rank, place) over a linked list."""
        rank, made, n = self.rank, self.made, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for at in range(n - 1):
            if (r := rank(ids[at] << 32 | ids[at + 1])) is not None:
                heap.append((r, at))
        heapify(heap)
        while heap:
            r, at = heappop(heap)
            if ids[at] < 0 or (right := after[at]) >= n or rank(ids[at] << 32 | ids[right]) != r:
                continue  # one of the two went into another token
            ids[at], ids[right] = made[r], -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
                if (r := rank(ids[at] << 32 | ids[after[at]])) is not None:
                    heappush(heap, (r, at))
            if (left := before[at]) >= 0 and (r := rank(ids[left] << 32 | ids[at])) is not None:
                heappush(heap, (r, left))
        return [i for i in ids if i >= 0]

    def stable(self, data: bytes) -> Iterator[int]:
        """The stable ids at the start of a long word; ``rest`` keeps the bytes behind them."""
        at = 0
        while len(data) - at > self.block:
            stop = 0
            for i in self.merge(data[at : at + self.block]):
                size = self.length_of[i]
                if stop + size > BLOCK:
                    break
                yield i
                stop += size
            at += stop
        self.rest = data[at:]


class Encoder:
    """Text in, stable ids out: ``feed`` pieces of a text, then ``finish``."""

    def __init__(self, vocabulary: Vocabulary):
        self.words = Words(vocabulary)
        self.special = vocabulary.special
        self.hold = max(map(len, self.special), default=1) - 1
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.control = re.compile("|".join(names)) if names else None
        self.plain = _patterns(r"\p{L}", r"\p{N}")
        self.narrow = _narrow_patterns()
        self.newer = re.compile(f"[{vocabulary.unlike}]") if vocabulary.unlike else None
        if self.newer:
            but = f"--[{vocabulary.unlike}]]"
            self.exact = _patterns(rf"[\p{{L}}{but}", rf"[\p{{N}}{but}")
        self._reset()

    def _reset(self) -> None:
        self.text = ""  # not yet searched for control strings
        self.open = ""  # words that more text may change
        self.run = None  # kind of a long word whose bytes go through as they come
        self.bytes = b""  # its bytes that are not stable

    def feed(self, text: str) -> list[int]:
        return self._control(self.text + text, last=False)

    def finish(self) -> list[int]:
        ids = self._control(self.text, last=True)
        self._reset()
        return ids

    def learn(self, texts: list[str]) -> None:
        """Work out the words of these texts together, before they are encoded one by one."""
        words: set[str] = set()
        for text in texts:
            for at in range(0, len(text), CHUNK):
                part = text[at : at + CHUNK]
                words.update(self._patterns_for(part)[0].findall(part))
        self.words.learn(words)

    def encode(self, text: str) -> list[int]:
        """All ids of a text at once."""
        ids: list[int] = []
        for at in range(0, len(text), CHUNK):
            ids += self.feed(text[at : at + CHUNK])
        return ids + self.finish()

    def _control(self, text: str, last: bool) -> list[int]:
        ids: list[int] = []
        at, stop = 0, len(text) if last else max(0, len(text) - self.hold)
        if self.control:
            for found in self.control.finditer(text):
                if found.start() >= stop:
                    break
                ids += self._words(text[at : found.start()], last=True)
                ids.append(self.special[found.group()])
                at = found.end()
        stop = max(at, stop)
        ids += self._words(text[at:stop], last)
        self.text = text[stop:]
        return ids

    def _words(self, text: str, last: bool) -> list[int]:
        """Ids of the words that are complete; a word is when the character behind it and one more are
        known, as an apostrophe and a run of white space look that far."""
        text = self.open + text
        words, runs = self._patterns_for(text)
        ids: list[int] = []
        at = 0
        if self.run:
            at = runs[self.run].match(text).end()
            goes_on = at == len(text) and not last
            if self.run == "space" and (goes_on or at < len(text)):
                at -= 1  # the last one goes to the word behind, if there is one
            self.bytes += text[:at].encode()
            if goes_on:
                self.open = text[at:]
                return self._stable()
            ids += self._stable()
            ids += self.words.merge(self.bytes)
            self.run, self.bytes = None, b""
        found = words.findall(text, at)
        stop = len(text)
        if not last:
            while found and stop > len(text) - 2:
                stop -= len(found.pop())
        ids.extend(chain.from_iterable(map(self.words.__getitem__, found)))
        self.open = text[stop:]
        if len(self.open) > LONG and words.match(self.open).end() == len(self.open):
            self.run = next(k for k, run in runs.items() if run.fullmatch(self.open[-1]))
            keep = 1 if self.run == "space" else 0
            stop = len(self.open) - keep
            self.bytes, self.open = self.open[:stop].encode(), self.open[stop:]
            ids += self._stable()
        return ids

    def _patterns_for(self, text: str):
        if text.isascii() or _is_narrow(text):
            return self.narrow
        return self.exact if self.newer and self.newer.search(text) else self.plain

    def _stable(self) -> list[int]:
        ids = list(self.words.stable(self.bytes))
        self.bytes = self.words.rest
        return ids


def _patterns(letter: str, digit: str):
    """The words, and what goes on with each kind of run."""
    other = rf"[^\s{letter}{digit}]"
    words = _WORDS.replace("{L}", letter).replace("{N}", digit).replace("{O}", other)
    runs = {"letter": f"{letter}*", "digit": f"{digit}*", "space": r"\s*", "other": f"{other}*"}
    flags = regex.VERSION1  # sets may hold sets and differences
    return regex.compile(words, flags), {k: regex.compile(v, flags) for k, v in runs.items()}


def _is_narrow(text: str) -> bool:
    """True if all code points are below 256."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@cache
def _narrow_patterns():
    """The same words for text with code points below 256 only, in the plain pattern module: twice as fast."""
    few = "".join(map(chr, range(256)))
    letter, digit, space = (
        "".join(map(re.escape, regex.findall(kind, few))) for kind in (r"\p{L}", r"\p{N}", r"\s")
    )
    words = rf" ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+"
    runs = {"letter": f"[{letter}]*", "digit": f"[{digit}]*", "space": f"[{space}]*"}
    runs["other"] = f"[^{space}{letter}{digit}]*"
    short = _WORDS[: _WORDS.index(" ")]
    return re.compile(short + words), {k: re.compile(v) for k, v in runs.items()}


class Decoder:
    """Ids in, text out; what is no UTF-8 becomes U+FFFD.  At most three bytes are held back."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = vocabulary.bytes_of.__getitem__
        self.held = b""

    def feed(self, ids: Iterable[int]) -> str:
        data = self.held + b"".join(map(self.bytes_of, ids))
        stop = len(data)
        for back in range(1, min(3, stop) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                if back < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                    stop -= back  # the code point isn't complete
                break
            if lead < 0x80:
                break
        self.held = data[stop:]
        return data[:stop].decode(errors="replace")

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode(errors="replace")

    def decode(self, ids) -> str:
        """The whole text of a list of ids."""
        out = [self.feed(ids[at : at + CHUNK]) for at in range(0, len(ids), CHUNK)]
        return "".join([*out, self.finish()])


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, ids``: the token ids of each text under the tokenizer file ``path``.

    Control strings in a text become their ids.  A null text counts as empty and has no ids; equal rows
    and rows without a key stay rows of their own; an empty table gives an empty one; other columns are
    not read.  The file is read by the driver and its tables (some megabytes, fixed by the file) go to the
    tasks.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches):
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            for part in _parts(batch):
                texts = [text or "" for text in part.column(1).to_pylist()]
                encoder.learn(texts)
                sizes, ids = [0], []
                for text in texts:
                    ids += encoder.encode(text)
                    sizes.append(len(ids))
                yield _ids_batch(part.column(0), sizes, ids)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, ids array<int>"
    ).withColumnRenamed("key", key)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``PART`` bytes of text, beyond those of the last one."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // PART
    ends = np.append(np.flatnonzero(np.diff(part)) + 1, len(part))
    start = 0
    for end in ends.tolist():
        if end > start:
            yield batch.slice(start, end - start)
        start = end


def _ids_batch(keys: pa.Array, sizes: list[int], ids: list[int]) -> pa.RecordBatch:
    listed = pa.ListArray.from_arrays(
        pa.array(np.array(sizes, np.int32)), pa.array(np.array(ids, np.int32))
    )
    return pa.RecordBatch.from_arrays([keys, listed], names=["key", "ids"])


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``key, ids, decoded``: the text of each list ``ids``; null ids count as none.

    Ids that the file doesn't have raise an error, as no text could stand for them.
    """
    vocabulary = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches):
        decoder = Decoder(vocabulary.value)
        for batch in batches:
            lists = batch.column(1)
            ids, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            spans = zip(ends[:-1], ends[1:], lists.is_valid().to_pylist(), strict=True)
            texts = [decoder.decode(ids[a:b].tolist() if valid else []) for a, b, valid in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(texts, pa.string())], names=["key", "ids", "decoded"]
            )

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(F.col(key).alias("key"), "ids").mapInArrow(
        run, f"key {kind}, ids array<int>, decoded string"
    ).withColumnRenamed("key", key)
