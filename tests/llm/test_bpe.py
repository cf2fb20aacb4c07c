"""The streaming tokenizer against the library it has to agree with."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldmill.llm import bpe
from fieldmill.llm.queries import op12_bpe
from fieldmill.llm.tables import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = (
    list("abcdest'rvemlld  \t\n 　!?.,0123٣éßü中\U0001f600՘\U000107bb\x1c\x85\xa0²")
    + ["<|endoftext|>", "<|endof", "text|>", "'ll", "'re", "   ", "\n\n", " the", "tion"]
    + ["a" * 700, " " * 800, "!" * 900, "7" * 600, "中" * 500, "ab" * 3000]
)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(PATH)


def texts(n, seed):
    chosen = random.Random(seed)
    return ["".join(chosen.choice(PARTS) for _ in range(chosen.randrange(40))) for _ in range(n)]


def test_pieces_of_any_size_give_the_same_ids(library, vocabulary):
    chosen, encoder = random.Random(1), bpe.Encoder(vocabulary)
    for text in texts(600, 2):
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == want
        ids, at = [], 0
        while at < len(text):
            size = chosen.choice((1, 2, 3, 7, 50, 600, 5000))
            ids += encoder.feed(text[at : at + size])
            at += size
        assert ids + encoder.finish() == want


def test_memory_stays_bounded_in_a_long_word(library, vocabulary):
    encoder = bpe.Encoder(vocabulary)
    for word in ("thean" * 8, "é", " ", "-="):
        text = "x " + word * 20_000
        ids, held = [], 0
        for at in range(0, len(text), 1000):
            ids += encoder.feed(text[at : at + 1000])
            held = max(held, len(encoder.bytes) + len(encoder.open) + len(encoder.text))
        assert ids + encoder.finish() == library.encode(text, add_special_tokens=False).ids
        assert held <= vocabulary.lookahead + bpe.BLOCK + 4000


def test_lookahead_is_sufficient_and_needed(vocabulary):
    words = bpe.Words(vocabulary)
    chosen, most = random.Random(4), 0
    parts = [b.decode() for b in vocabulary.bytes_of.values() if b.isalpha() and b.isascii()]
    for _ in range(3000):
        start = "".join(chosen.choice(parts) for _ in range(6))
        more = "".join(chosen.choice(parts) for _ in range(3))
        ends = [set(), set()]
        for k, text in enumerate((start, start + more)):
            stop = 0
            for i in words.merge(text.encode()):
                stop += words.length_of[i]
                ends[k].add(stop)
        common = max((e for e in range(len(start) + 1) if {x for x in ends[0] if x <= e} == {x for x in ends[1] if x <= e}), default=0)
        most = max(most, len(start) - max((e for e in ends[0] & ends[1] if e <= common), default=0))
    assert 0 < most <= vocabulary.lookahead


def test_small_merge_list_has_the_lookahead_worked_out_by_hand():
    # "bca" is [bc] [a], but "bcab" is [b] [cab]: the last byte changes a token that starts three before it
    single = list(range(256))
    a, b, c = map(ord, "abc")
    pairs = {a << 32 | b: 0, c << 32 | 256: 1, b << 32 | c: 2}
    v = bpe.Vocabulary(pairs, [256, 257, 258], single, {i: bytes([i]) for i in single}, {}, "")
    words = bpe.Words(v)
    assert (words.merge(b"bca"), words.merge(b"bcab")) == ([258, a], [b, 257])
    assert v.lookahead == 3


def test_learned_words_are_those_merged_one_by_one(vocabulary):
    words = bpe.Words(vocabulary)
    chosen = random.Random(8)
    some = {"".join(chosen.choice("ethanisor éü") for _ in range(chosen.randrange(1, 30))) for _ in range(3000)}
    words.learn(some)
    assert all(list(words[w]) == words.merge(w.encode()) for w in some if w in words)
    assert sum(w in words for w in some) > 2500


def test_decoder_is_the_librarys_on_any_ids(library, vocabulary):
    chosen, decoder = random.Random(9), bpe.Decoder(vocabulary)
    for _ in range(3000):
        ids = [chosen.randrange(50_257) if chosen.random() < 0.5 else chosen.randrange(256) for _ in range(12)]
        got = "".join(decoder.feed([i]) for i in ids) + decoder.finish()
        assert got == library.decode(ids, skip_special_tokens=False) == decoder.decode(ids)


def test_other_kinds_of_files_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        good = json.load(file)
    for part, value in (("normalizer", {"type": "NFC"}), ("pre_tokenizer", {"type": "Whitespace"})):
        path = tmp_path / f"{part}.json"
        path.write_text(json.dumps(good | {part: value}))
        with pytest.raises(ValueError):
            bpe.read_vocabulary(str(path))
    late = good["model"]["merges"][::-1]
    (tmp_path / "late.json").write_text(json.dumps(good | {"model": good["model"] | {"merges": late}}))
    with pytest.raises(ValueError):
        bpe.read_vocabulary(str(tmp_path / "late.json"))


def test_query_equals_the_library(spark, sf_dir, library):
    found = {r.doc_id: r for r in op12_bpe(spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "documents").collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        got = found[row.doc_id]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(odd, library):
    rows = bpe.decode(bpe.encode(odd.selectExpr("*", "'x' AS ids", "'x' AS key"), PATH), PATH).collect()
    want = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=str)
    assert sorted(((r.doc_id, r.decoded) for r in rows), key=str) == want
    assert all(r.ids == library.encode(r.decoded, add_special_tokens=False).ids for r in rows)
    assert bpe.decode(bpe.encode(odd.limit(0), PATH), PATH).count() == 0
