"""Benchmark items in training texts: word pair seeds, then Smith-Waterman alignment.

An item is aligned with a text word by word, case and ASCII punctuation apart (match 2, mismatch and
gap -1), and the score is the best local alignment over that of the item with itself.  Edited copies
thus score the share of them that still agrees.

Seeding is complete for scores of THRESHOLD = 0.5.  Let an alignment of an item of n words have M
matches and E edits, 2 M - E >= n.  Call two matches in a row a link if they are neighbours in the item
and at most one word apart in the text.  A step that is no link either leaves out words of the item
(b of these, b <= n - M, one edit or more each) or has two edits or more, so b + 2 c <= E <= 2 M - n and
the links are M - 1 - b - c >= n / 2 - 1 - b / 2 >= n / 3 - 1, as b <= n / 3.  Their diagonals (place in
the text minus place in the item) differ by at most E <= n.  So only items with that many links within
n diagonals are aligned, and only around these.

The benchmark is the query side: it goes to the tasks in blocks of bounded size, one pass over the
documents for each block (a single one for up to about 200,000 words of benchmark), so documents are
never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.words import _STEP, U, Block, mix, slices, word_block

THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: words of benchmark that one pass over the documents takes
BLOCK_WORDS = 200_000
#: links of texts with items that are held at once, a single text's apart
MAX_LINKS = 1 << 20

MATCHES = "doc_id long, item_id long, score double, start_word long, end_word long"


@dataclass
class Items:
    """A block of items: ids, hashes of the words of each, and their seeds by hash."""

    ids: list[int]
    words: list[np.ndarray]
    #: links that an alignment of each has at least
    need: np.ndarray
    length: np.ndarray
    #: sorted hashes; those of place k are seeds first[k] to first[k + 1]
    distinct: np.ndarray
    first: np.ndarray
    item: np.ndarray
    pos: np.ndarray

    @staticmethod
    def of(rows) -> Items:
        block = word_block([text for _, text in rows], plain=True)
        words = [block.hash[a:b] for a, b in zip(block.first[:-1], block.first[1:], strict=True)]
        length = np.array([len(w) for w in words], np.int64)
        # an item of one word is its own seed; of three words the outer two are a seed as well
        parts = []
        for gap, of_length in ((0, length == 1), (1, length > 1), (2, length == 3)):
            at, seed = _pairs(block, gap)
            fits = of_length[block.doc[at]]
            parts.append((seed[fits], at[fits]))
        seed, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(seed, kind="stable")
        seed, at = seed[order], at[order]
        distinct, first = np.unique(seed, return_index=True)
        item = block.doc[at]
        return Items(
            [i for i, _ in rows],
            words,
            np.maximum(1, -(-(length - 3) // 3)),
            length,
            distinct,
            np.append(first, len(seed)),
            item,
            at - block.first[item],
        )


def _pairs(block: Block, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of each word with the one ``gap`` places on in its text; 0 means the word alone."""
    n = max(0, len(block.hash) - gap)
    at = np.flatnonzero(block.doc[:n] == block.doc[gap : gap + n])
    if not gap:
        return at, mix(block.hash + U(1))
    return at, mix(block.hash[at + gap] * _STEP + block.hash[at] + U(2))


def _found(block: Block, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(position in the block, place in ``items.distinct``) of the seeds in texts, by position."""
    places, found = [], []
    for gap in (0, 1, 2):
        at, seed = _pairs(block, gap)
        where = np.minimum(np.searchsorted(items.distinct, seed), max(0, len(items.distinct) - 1))
        hit = np.flatnonzero(items.distinct[where] == seed) if len(items.distinct) else at[:0]
        places.append(at[hit])
        found.append(where[hit])
    at, where = np.concatenate(places), np.concatenate(found)
    order = np.argsort(at, kind="stable")
    return at[order], where[order]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The best local alignment score and the place after its last word in ``text``."""
    step = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    best = end = 0
    for word in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(text == word, MATCH, MISMATCH))
        row = np.maximum.accumulate(new - GAP * step) + GAP * step
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _best(item: np.ndarray, words: np.ndarray, need: int, diagonal: np.ndarray, pos: np.ndarray):
    """Best (score, start, end) of an item over the regions around its links, which come by diagonal."""
    size = len(item)
    apart = np.flatnonzero(np.diff(diagonal) > size) + 1
    found = (0.0, 0, 0)
    for part, places in zip(np.split(diagonal, apart), np.split(pos, apart), strict=True):
        if len(np.unique(places)) < need:
            continue  # the same links again
        low = max(0, int(part[0]) - size)
        high = min(len(words), int(part[-1]) + 2 * size)
        region = words[low:high]
        if np.isin(item, region).sum() < THRESHOLD * size:
            continue  # too few common words for the threshold in any order
        best, end = align(item, region)
        score = best / (MATCH * size)
        if score > found[0]:
            _, back = align(item[::-1], region[:end][::-1])
            found = (score, low + end - back, low + end)
    return found


def _candidates(block: Block, items: Items):
    """Per text and item with links enough: (text, item, diagonals, places in the item)."""
    at, found = _found(block, items)
    times = items.first[found + 1] - items.first[found]
    total = np.append(0, np.cumsum(times))
    bounds = np.searchsorted(at, block.first)
    text = 0
    while text < len(bounds) - 1:
        low = bounds[text]
        stop = int(np.searchsorted(total[bounds], total[low] + MAX_LINKS, "right")) - 1
        text = max(text + 1, stop)
        high = bounds[text]
        # each seed found stands for all its places in items
        n = times[low:high]
        place = np.repeat(items.first[found[low:high]] - (total[low:high] - total[low]), n)
        place += np.arange(len(place))
        own = np.repeat(at[low:high], n)
        doc, item, pos = block.doc[own], items.item[place], items.pos[place]
        diagonal = own - block.first[doc] - pos
        order = np.lexsort((diagonal, item, doc))
        doc, item, diagonal, pos = doc[order], item[order], diagonal[order], pos[order]
        # the last of the links that would be enough from this one on
        last = np.arange(len(doc)) + items.need[item] - 1
        fits = np.flatnonzero(last < len(doc))
        to = last[fits]
        fits = fits[
            (doc[to] == doc[fits])
            & (item[to] == item[fits])
            & (diagonal[to] - diagonal[fits] <= items.length[item[fits]])
        ]
        cover = np.zeros(len(doc) + 1, np.int64)
        np.add.at(cover, fits, 1)
        np.add.at(cover, last[fits] + 1, -1)
        kept = np.flatnonzero(np.cumsum(cover[:-1]))
        doc, item, diagonal, pos = doc[kept], item[kept], diagonal[kept], pos[kept]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
        cuts = np.append(np.flatnonzero(new), len(doc))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(doc[a]), int(item[a]), diagonal[a:b], pos[a:b]


def _matcher(items: Items):
    """A function from a list of texts to the (number of the text, item_id, score, start, end) of
    their matches."""

    def matches(texts):
        for low, high in slices(texts):
            block = word_block(texts[low:high], plain=True)
            for i, k, diagonal, pos in _candidates(block, items):
                words = block.hash[block.first[i] : block.first[i + 1]]
                score, start, end = _best(items.words[k], words, items.need[k], diagonal, pos)
                if score >= THRESHOLD:
                    yield low + i, items.ids[k], score, start, end

    return matches


def _blocks(benchmark: DataFrame, block_words: int):
    """The items of ``benchmark`` in blocks of about ``block_words`` words."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").distinct()
    items = items.where("text is not null")
    total = items.agg(F.sum(F.size(F.split(F.trim("text"), "\\s+")))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for block in range(blocks):
        own = items
        if blocks > 1:
            own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Items.of(sorted((tuple(r) for r in own.collect()), key=str))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Pairs of document and benchmark item that align: doc_id, item_id, score, start_word, end_word.

    ``docs`` (doc_id, text) and ``benchmark`` (item_id, text); one row per pair with a score of 0.5 or
    more, with the words of the document (from 0, end exclusive) that align best.  An item of
    one word has to stand in the text, one of two words with at most one word between.  Null, empty and blank texts match nothing; null ids are
    kept as ids; repeated benchmark rows count once, repeated documents each; of equally good places
    the first of the best is told; empty tables give no rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    found = None
    for items in _blocks(benchmark, block_words):
        matches = _matcher(items)

        def run(batches, matches=matches):
            for batch in batches:
                names = batch.column(0).to_pylist()
                rows = [(names[i], *rest) for i, *rest in matches(batch.column(1).to_pylist())]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["doc_id", "item_id", "score", "start_word", "end_word"],
                )

        part = docs.mapInArrow(run, MATCHES)
        found = part if found is None else found.union(part)
    return found


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; rows are judged one by one."""
    left = docs
    for items in _blocks(benchmark, block_words):
        matches = _matcher(items)

        def run(batches, matches=matches):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[i for i, *_ in matches(batch.column("text").to_pylist())]] = False
                yield batch.filter(pa.array(clean))

        left = left.mapInArrow(run, docs.schema)
    return left
