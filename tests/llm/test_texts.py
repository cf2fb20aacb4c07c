"""License scan, toxicity, fingerprints and decontamination."""

import hashlib
import re

import numpy as np

import fieldmill.llm.decontamination as D
import fieldmill.llm.fingerprints as F
import fieldmill.llm.licenses as L
import fieldmill.llm.toxicity as T
from fieldmill.llm.tables import table
from fieldmill.llm.words import word_block

# ---- licenses ----------------------------------------------------------------------------------------


def brute_licenses(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    places, base = [], set()
    for t in L.BASE:
        n = len(t.words)
        at = [i for i in range(len(w) - n + 1) if w[i : i + n] == t.words]
        places += at
        base |= {t.label} if at else set()
    labels = set(base)
    for t in L.NOTICES:
        if any(len(set(t.words) & set(w[i : i + t.stretch])) >= t.need for i in range(len(w))):
            labels.add(t.label)
    ends = (min(places), max(places)) if places else (None, None)
    return (len(w), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)))


def scanned(frame):
    return sorted(
        ((r.doc_id, r[1:7]) for r in L.scan(frame).collect()), key=lambda x: (str(x[0]), x[1][0])
    )


def expected(frame):
    return sorted(
        ((r.doc_id, brute_licenses(r.text)) for r in frame.collect()),
        key=lambda x: (str(x[0]), x[1][0]),
    )


def test_licenses_equal_brute_force(docs, odd):
    assert scanned(docs) == expected(docs)
    assert scanned(odd) == expected(odd)
    assert L.scan(odd.limit(0)).count() == 0


def test_license_blocks(spark):
    bsd = L.NOTICES[-1].text
    texts = [
        "MIT-License, mit license! MIT  LICENSE",
        "mit licence licensemit license mit",
        "GNU\ngeneral\tpublic license and the Apache License (cc by)",
        bsd.replace("source", "sauce"),
        "x " * 30 + bsd.upper() + " y" * 30,
        bsd.replace("source", "a").replace("binary", "b").replace("forms", "c"),
        "é" * 50 + " cc by",
        "by cc by by cc",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert scanned(frame) == expected(frame)
    scores = {r.doc_id: r.score for r in L.scan(frame).collect()}
    assert scores[0] == 1.0 and 0.9 <= scores[3] < 1 and scores[5] == 0.0


def test_license_scan_stays_native(docs):
    plan = L.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# ---- toxicity ------------------------------------------------------------------------------------------


def area(scores, labels):
    order = np.argsort(scores)
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    n = labels.sum()
    return (rank[labels].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


def test_toxicity_on_the_held_out_fold(spark):
    big = "/root/testdata/sf0.1"
    labels = table(spark, big, "labels")
    got = T.toxicity(table(spark, big, "documents"), labels).join(labels, "doc_id")
    rows = got.where("held_out and toxic is not null").toPandas()
    truth = rows["toxic"].to_numpy() == 1
    assert area(rows["score"].to_numpy(), truth) > 0.97
    flagged = rows["predicted"].to_numpy() == 1
    assert flagged[truth].mean() > 0.85 and flagged[~truth].mean() < 0.02


def test_toxicity_of_odd_rows(spark, docs, odd, sf_dir):
    labels = table(spark, sf_dir, "labels")
    got = T.toxicity(odd, labels)
    assert got.count() == odd.count() and got.where("score < 0 or score > 1").isEmpty()
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].score == by[2].score and by[None].held_out
    assert T.toxicity(odd.limit(0), labels).count() == 0
    same = {r.score for r in T.toxicity(docs, labels.limit(0)).collect()}
    assert len(same) == 1
    kept = T.drop_toxic(odd, docs, labels)
    assert kept.columns == odd.columns and kept.count() <= odd.count()


def test_labels_of_the_held_out_fold_teach_nothing(spark, docs, sf_dir):
    labels = table(spark, sf_dir, "labels")
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - toxic, toxic) AS toxic"
    )
    a = T.toxicity(docs, labels).orderBy("doc_id").collect()
    b = T.toxicity(docs, flipped).orderBy("doc_id").collect()
    assert np.allclose([r.score for r in a], [r.score for r in b])


# ---- fingerprints ----------------------------------------------------------------------------------------


def test_fingerprints(docs, monkeypatch):
    monkeypatch.setattr(F, "RANGE_DOCUMENTS", 30)
    got = {r.doc_id: r for r in F.fingerprints(docs).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    by_text = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert (r.fingerprint == r.edited_fingerprint) <= (sorted(text.split("\n")) == sorted(edit.split("\n")))
    assert len(set(by_text.values())) == len(by_text)
    near = np.array([(r.near_edited, r.near_next) for r in got.values()])
    assert near.min() >= 0 and near.max() <= 1 and near[:, 0].mean() > 0.4 and near[:, 1].mean() < 0.15


def test_fingerprints_are_homomorphic():
    a, b, both, other = (
        F.vectors([t]) for t in ("one a b\ntwo", "three c\ntwo", "two\nthree c\none a b\ntwo", "one a b")
    )
    same = lambda x, y: all((p == q).all() for p, q in zip(x, y, strict=True))
    assert same(F.combined(a, b), both)
    assert same(F.combined(both, b, -1), a)
    assert not same(a, other) and not same(F.vectors(["x\nx"]), F.vectors(["x"]))


def test_likeness_of_a_line_repeated_very_often():
    a, b = (F.vectors(["\n".join(["one line of five words"] * n)]) for n in (50_000, 25_000))
    assert F.likeness(a, b)[0] > 0.999


def test_fingerprints_of_odd_rows(odd):
    got = F.fingerprints(odd).collect()
    assert len(got) == odd.count() and F.fingerprints(odd.limit(0)).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint or by[1].n_chars == 0
    assert by[5].near_next > 0.9 and by[4].near_next in (1.0, by[4].near_next)
    alone = F.fingerprints(odd.where("doc_id = 7")).first()
    assert alone.near_next == 1.0


# ---- decontamination ------------------------------------------------------------------------------------


def normal(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower()) if w]


def slow_alignment(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            fit = rows[-1][j] + (2 if x == y else -1)
            row.append(max(0, fit, rows[-1][j + 1] - 1, row[j] - 1))
        rows.append(row)
    return max(map(max, rows)) / (2 * len(a))


def test_contaminated_equals_alignment_of_all_pairs(spark, docs, sf_dir):
    benchmark = table(spark, sf_dir, "benchmark")
    chosen = docs.where("length(text) < 1500")
    items = [(r.item_id, normal(r.text)) for r in benchmark.collect()]
    want = {}
    for r in chosen.collect():
        w = normal(r.text)
        for i, item in items:
            if len(set(item) & set(w)) * 2 >= len(set(item)):
                score = slow_alignment(item, w)
                if score >= 0.5:
                    want[r.doc_id, i] = score
    for words in (D.BLOCK_WORDS, 300):
        got = D.contaminated(chosen, benchmark, words).collect()
        assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got} == {
            k: round(v, 9) for k, v in want.items()
        }


def test_edited_leaks(spark):
    item = "The quick brown fox jumps over the lazy dog while seven bright birds sing in old green trees"
    edited = item.replace("brown", "red").replace("seven", "eight or nine").replace(" old", "")
    rows = [
        (1, "before " * 20 + item.upper().replace(" ", "!! ") + " after" * 20),
        (2, "before " * 20 + edited + " after" * 20),
        (3, "the fox and the dog in the trees while birds sing over seven old lazy green hills " * 3),
        (4, None),
        (5, ""),
        (6, item[: len(item) // 3]),
        (7, "hi there"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, ""), (4, "hi there")], "item_id long, text string"
    )
    got = {(r.doc_id, r.item_id): r for r in D.contaminated(frame, items).collect()}
    assert set(got) == {(1, 1), (2, 1), (7, 4)}
    assert got[1, 1].score == 1 and got[1, 1].start_word == 20 and 0.6 < got[2, 1].score < 1
    assert sorted(r.doc_id for r in D.drop_contaminated(frame, items).collect()) == [3, 4, 5, 6]
    assert D.contaminated(frame, items.limit(0)).count() == 0
    assert D.contaminated(frame.limit(0), items).count() == 0


def test_leaks_without_unchanged_runs(spark):
    item = [f"w{i}" for i in range(20)]
    short = ["x0", "x1", "x2"]
    texts = [
        *([f"new{i}" if i % k == k - 1 else w for i, w in enumerate(item)] for k in (3, 4, 6)),
        [x for w in item for x in (w, "in")][:-1],
        [w for i, w in enumerate(item) if i % 4],
        [x for i, w in enumerate(item) for x in ((w, "in", "between") if i % 3 == 0 else (w,))],
        ["x0", "new", "x2"],
        ["x0", "x2"],
        ["x1", "new", "x2"],
    ]
    random = np.random.default_rng(7)
    for _ in range(300):
        texts.append(
            [
                x
                for w in item
                for x in [[w], [w], [w, "in"], ["new"], [], [w, w], ["w3"]][random.integers(7)]
            ]
        )
    texts = [["out"] * 9 + t + ["out"] * 9 for t in texts]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short))], "item_id long, text string")
    want = {}
    for k, t in enumerate(texts):
        for i, x in ((1, item), (2, short)):
            score = slow_alignment(x, t)
            if score >= 0.5:
                want[k, i] = round(score, 9)
    assert {k for k, _ in want} >= set(range(9))
    got = D.contaminated(frame, items).collect()
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got} == want
    assert {r.doc_id for r in D.drop_contaminated(frame, items).collect()} == set(
        range(len(texts))
    ) - {k for k, _ in want}


def test_alignment_like_the_textbook():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (rng.integers(0, 4, rng.integers(1, 12)) for _ in range(2))
        score, end = D.align(a, b)
        assert score == round(slow_alignment(a.tolist(), b.tolist()) * 2 * len(a)) and end <= len(b)


def test_plain_words():
    block = word_block(["A.b-C é1", None], plain=True)
    assert np.diff(block.first).tolist() == [4, 0]
