"""Fill-in-the-middle, fingerprints and centroid clustering against brute force, and on nulls,
empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspark.llm import clusters, fingerprints, infilling
from tallyspark.llm.wavelet import WaveletMatrix
from tests.helpers import plan_text

LONG = "word ü " * 60_000 + "x" * 200_000
#: Columns that clash with names used inside the operators.
CLASHES = "digest string, key long, n long, h1 long, form string, a long, copies long"


def odd_docs(spark):
    texts = [
        (1, "One two three four five six seven"),
        (2, "One two three four five six seven"),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, LONG),
        (7, "Ünïcödé 🙂🙃 text\nwith lines\n\nand 漢字 too"),
        (7, "Ünïcödé 🙂🙃 text\nwith lines\n\nand 漢字 too"),
        (7, "another text under the same id"),
        (None, "no id here"),
        (None, "no id there"),
        (None, "no id here"),
        (8, "holds <P> a marker"),
        (9, "x"),
        (10, "nearly <S a <M marker < > <P"),
    ]
    rows = [(i, t, "d", 1, 2, 3, "f", 4, 5) for i, t in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHES}")


# ---------------------------------------------------------------- fill in the middle
def test_ranks_and_bisection_match_counts():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 6, size).astype(np.uint8)
        matrix = WaveletMatrix(symbols, 3)
        at = np.arange(size + 1)
        for s in range(6):
            assert (matrix.rank(s, at) == np.array([(symbols[:i] == s).sum() for i in at])).all()
        counts = np.array([np.isin(symbols[:i], (1, 4)).sum() for i in at])
        for most in range(int(counts.max()) + 1):
            found = matrix.last_with((1, 4), np.array([most]), np.array([0]), np.array([size]))
            assert found[0] == max(i for i in at if counts[i] <= most)


def starts_of(text, unit):
    if unit == "char":
        return list(range(len(text)))
    pattern = r"[^\x20\x09-\x0D]+" if unit == "word" else r"[^\n]*\n|[^\n]+"
    return [m.start() for m in re.finditer(pattern, text)]


def brute_infilling(doc_id, text, unit="char"):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    starts = starts_of(text, unit)
    n = len(starts)
    bounds = [0, *starts[1:], len(text)] if n else [0]
    a, b = (bounds[k] for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    plain = not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
    form = "plain" if plain else "spm" if h[3] % 100 < 20 else "psm"
    before, middle, after = text[:a], text[a:b], text[b:]
    output = {"plain": text, "psm": f"<P>{before}<S>{after}<M>{middle}", "spm": f"<S>{after}<P>{before}<M>{middle}"}[form]
    return doc_id, n, form, output, None if plain else a, None if plain else b - a


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_infilling(spark, unit):
    docs = odd_docs(spark)
    got = infilling.transform(docs, unit=unit).select("doc_id", "n", "form", "output", "prefix_chars", "middle_chars")
    expected = [brute_infilling(r.doc_id, r.text, unit) for r in docs.collect()]
    assert Counter(map(tuple, got.collect())) == Counter(expected)
    back = infilling.transform(docs, unit=unit).select("doc_id", infilling.restore(F.col("output"), F.col("form")))
    assert Counter(map(tuple, back.collect())) == Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert infilling.transform(docs.where("false"), unit=unit).count() == 0


def test_infilling_of_random_texts(spark):
    rng = random.Random(11)
    texts = [(i, "".join(rng.choices("ab <>PSM\n\t é漢🙂", k=rng.randint(0, 40)))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = infilling.digests(docs).collect()
    for r in got:
        _, n, form, output, prefix, middle = brute_infilling(r.doc_id, texts[r.doc_id][1])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(texts[r.doc_id][1].encode()).hexdigest()
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    with pytest.raises(ValueError):
        infilling.transform(docs, unit="page")


# ---------------------------------------------------------------- fingerprints
def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    votes, total = Counter(), 0
    for before, word in zip(["", *found], found, strict=False):
        high = xxhash.xxh64_intdigest(word.encode(), xxhash.xxh64_intdigest(before.encode(), 42))
        low = xxhash.xxh64_intdigest(before.encode(), xxhash.xxh64_intdigest(b"b", 42))
        votes[high << 64 | xxhash.xxh64_intdigest(word.encode(), low)] += len(word)
        total += len(word)
    return sum(1 << i for i in range(128) if 2 * sum(w for h, w in votes.items() if h >> i & 1) > total)


def brute_report(rows):
    """By distinct (id, text) in the operator's order."""
    digest = {t: hashlib.sha256(t.encode()).hexdigest() for _, t in rows}
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0), digest[r[1]]))
    prints = {t: brute_print(t) for _, t in order}
    out = {}
    for i, (doc_id, text) in enumerate(order):
        other = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        out[doc_id, text] = (edited, prints[text], brute_print(edited), prints[other])
    return out


def like(x, y):
    return max(0.0, math.cos((x ^ y).bit_count() * math.pi / 128))


def test_fingerprints(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    expected = brute_report(rows)
    prints = {r: expected[r][1] for r in expected}
    want = Counter()
    for doc_id, text in rows:
        edited, own, changed, following = expected[doc_id, text]
        near = sum((own ^ prints[r]).bit_count() <= 6 for r in rows) - 1 if doc_id is not None and doc_id % 2 == 0 else None
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want[doc_id, len(text), sha, f"{own:032x}", f"{changed:032x}", round(like(own, changed), 9), round(like(own, following), 9), near] += 1
    found = fingerprints.report(docs, F.expr("doc_id % 2 = 0"))
    got = Counter((*r[:5], round(r.near_edited, 9), round(r.near_next, 9), r.n_near) for r in found.collect())
    assert got == want
    assert fingerprints.report(docs.where("false"), F.lit(True)).count() == 0


def test_a_document_alone_follows_itself(spark):
    text = "one two three four"
    got = fingerprints.report(spark.createDataFrame([(4, text)], "doc_id int, text string"), F.lit(True)).collect()
    assert [(r.near_next, r.n_near) for r in got] == [(1.0, 0)]
    edited = text[:9] + text[:9]
    assert got[0].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_many_copies_of_a_row(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "COPIES", 7)
    rows = [(1, "the same row")] * 50 + [(2, "another row")]
    got = fingerprints.report(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).collect()
    assert Counter((r.doc_id, r.n_near) for r in got) == {(1, 49): 50, (2, 0): 1}
    assert len({r.fingerprint for r in got if r.doc_id == 1}) == 1


@pytest.mark.parametrize("kept", [1, 2, 3])
def test_block_tables_find_every_pair_once(kept):
    rng = random.Random(kept)
    tables = fingerprints.BlockTables(4, kept).tables
    every = 0
    for (a, b), _ in tables:
        every |= (a % (1 << 64)) << 64 | b % (1 << 64)
    assert every == (1 << 128) - 1
    for _ in range(300):
        change = sum(1 << i for i in rng.sample(range(128), rng.randint(0, 8)))
        high, low = change >> 64, change % (1 << 64)
        met = 0
        for (a, b), earlier in tables:
            agree = not (high & (a % (1 << 64))) and not (low & (b % (1 << 64)))
            met += agree and all(high & (x % (1 << 64)) or low & (y % (1 << 64)) for x, y in earlier)
        assert met <= 1 and (met == 1 or change.bit_count() > 4)


def test_radius_search_equals_brute_force(spark):
    rng = random.Random(7)
    centres = [rng.getrandbits(128) for _ in range(6)]
    values = []
    for _ in range(900):  # families larger than a cell, with repeats
        v = rng.choice(centres)
        for bit in rng.sample(range(128), rng.choice((0, 1, 2, 3, 5, 9))):
            v ^= 1 << bit
        values.append(v)
    signed = [(v >> 64, v % (1 << 64)) for v in values]
    signed = [tuple(x - (1 << 64) if x >> 63 else x for x in pair) for pair in signed]
    rows = spark.createDataFrame(signed, "a long, b long")
    queries = rows.limit(200)
    asked = {tuple(r) for r in queries.collect()}
    got = {(r.a, r.b): r.near for r in fingerprints.within_radius(rows, queries, radius=6, cell=16).collect()}
    as_int = dict(zip(signed, values, strict=True))
    assert got == {q: sum((as_int[q] ^ v).bit_count() <= 6 for v in values) for q in asked}


def test_fingerprint_plans_have_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = plan_text(fingerprints.report(docs, F.expr("doc_id % 20 = 0")))
    keyed = fingerprints._keyed(docs, "doc_id", "text")
    made = plan_text(fingerprints.simhash(keyed, ["key"], "text"))
    for plan in (found, made):
        assert not re.search("Python|Pandas|InArrow|CartesianProduct", plan)


# ---------------------------------------------------------------- clustering
def brute_clusters(rows, k=16, rounds=3, dim=64):
    kept = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(members[j]) for x in zip(*members[j], strict=True)] if j in members else c for j, c in enumerate(centres)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, distance, j in found:
        inertia[j] += distance
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), names[j]) for i, d, j in found)


@pytest.mark.parametrize(("dim", "shard", "k"), [(8, 3, 4), (8, 8, 16), (5, 1, 2)])
def test_clusters(spark, monkeypatch, dim, shard, k):
    monkeypatch.setattr(clusters, "ROWS", 7)
    rng = random.Random(dim * shard)
    rows = [(i, [rng.uniform(-2, 2) + 3 * (i % 3) for _ in range(dim)]) for i in range(60)]
    rows += [(i % 5, rows[0][1]) for i in range(30)]  # one common vector, repeated ids
    rows += [(None, rows[1][1]), (None, rows[2][1]), (100, None), (101, []), (102, [1.0] * (dim + 1))]
    rows += [(103, [None, *[1.0] * (dim - 1)]), (104, [float("nan"), *[1.0] * (dim - 1)]), (105, [float("-inf"), *[1.0] * (dim - 1)])]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, cluster long, block long")
    got = clusters.cluster(table, k=k, dim=dim, shard=shard)
    assert Counter(map(tuple, got.collect())) == brute_clusters(rows, k, 3, dim)
    assert clusters.cluster(table.where("false"), k=k, dim=dim).count() == 0


def test_row_blocks_are_cut(spark):
    rows = [(i, [float(i), float(-i)]) for i in range(50)]
    vectors = clusters.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1), "vec_id", "embedding", 2, 64)
    packed = clusters.pack(vectors, 2, shard=1, rows=16).collect()
    assert Counter(r.shard for r in packed) == {0: 4, 1: 4} and len({r.block for r in packed}) == 4
    ids = [i for r in packed if r.shard == 0 for i in r.ids]
    firsts = np.concatenate([np.frombuffer(r.data, np.int64) for r in packed if r.shard == 0])
    assert sorted(ids) == list(range(50)) and (firsts == 64 * np.array(ids)).all()


def test_components_that_could_overflow_are_an_error(spark):
    table = spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="may exceed a long"):
        clusters.cluster(table, dim=2).collect()


def test_folders_go_with_their_owner(spark):
    from tallyspark.llm import exact_dedup
    from tallyspark.scratch import Scratch
    from tallyspark.session import scratch_path
    from tallyspark.sources.files import list_names

    docs = odd_docs(spark).where("length(text) < 1000")
    before = list_names(spark, scratch_path(spark, "llm"))
    for build in (lambda: fingerprints.report(docs, F.lit(True)), lambda: exact_dedup.duplicate_groups(docs)):
        with Scratch(spark):
            assert build().count() > 0
            assert list_names(spark, scratch_path(spark, "llm")) != before
        assert list_names(spark, scratch_path(spark, "llm")) == before
