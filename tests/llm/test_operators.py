"""Each operator against brute force, and on nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns whose names clash with the operator's own."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import archives, exact_dedup, grading, jaccard, licenses, mixing, pages, pieces, private, topk, words

SF = "/root/testdata/sf0.001"
LONG = "word " * 60_000 + "x" * 200_000
BASE = "the quick brown fox jumps over the lazy dog and runs far away from every other animal in the wood " * 3


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [
        (1, BASE, "a", 1),
        (2, BASE.replace("lazy dog", "lazy  dog"), "a", 1),
        (3, BASE + "once more", "b", 1),
        (4, None, "b", 2),
        (5, "", None, 2),
        (6, " \t\n", None, 3),
        (7, LONG, "c", 3),
        (8, "Two words", "c", 4),
        (8, "Two words", "c", 4),
        (9, "two WORDS", "a", 4),
        (None, BASE, "a", 5),
        (10, "Mail a.b@c.de or +1 (487) 555-7209; card 4111 1111 1111 1111, host 10.0.0.1.", "d", 6),
        (11, "é " * 50 + "Released under the MIT License.", "d", 6),
    ]
    # columns that clash with names used inside the operators
    return spark.createDataFrame(
        [(*r, "k", 1.5) for r in rows], "doc_id long, text string, source string, digest long, __digest string, target double"
    )


def empty(df):
    return df.where(F.lit(False))


# ---------------------------------------------------------------- words
def test_shingle_sets_match_plain_python():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices("abAB é\t\n\x0b ", k=rng.randint(0, 60)))
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        expected = {tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} - {()}
        assert len(words.shingle_set(text)) == len(expected)


def test_word_hashes_do_not_depend_on_pieces():
    text = " ".join(f"w{i}" for i in range(40_000))
    assert (words.text_words(text) == np.concatenate([words.text_words(f"w{i}") for i in range(40_000)])).all()
    assert len(words.text_words("x" * 300_000 + " y")) == 2


# ---------------------------------------------------------------- exact dedup
def brute_dedup(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        taken = False
        for i in ids:
            kept, taken = (i == keep and not taken), taken or i == keep
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("counters", [2, 1000])
def test_exact_dedup(spark, odd_docs, counters):
    got = exact_dedup.duplicate_groups(odd_docs, counters=counters)
    assert Counter(tuple(r) for r in got.collect()) == brute_dedup([(r.doc_id, r.text) for r in odd_docs.collect()])
    kept = exact_dedup.drop_exact_copies(odd_docs, counters=counters)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 7, 8, 9, 10, 11]
    assert exact_dedup.duplicate_groups(empty(odd_docs)).count() == 0


def test_heavy_rows_are_not_shuffled(spark):
    import contextlib
    import io

    docs = spark.createDataFrame([(i, "hot" if i % 2 else f"t{i}") for i in range(400)], "doc_id long, text string")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        exact_dedup.duplicate_groups(docs, counters=10).explain()
    # what is counted by (digest, doc_id) was joined with the heavy digests or their winners before
    below = re.findall(r"HashAggregate\(keys=\[digest#\d+, doc_id#\d+L[^\n]*partial_count(.*?)FileScan", out.getvalue(), re.S)
    assert len(below) == 2 and all("BroadcastHashJoin" in b for b in below)


def test_summaries_never_overcount_and_find_heavy_rows():
    import pandas as pd

    values = pd.Series(["hot"] * 400 + [f"v{i}" for i in range(600)]).sample(frac=1, random_state=1)
    held = pd.Series(dtype="int64")
    for at in range(0, 1000, 100):
        held = exact_dedup.merge_counts(held, values.iloc[at : at + 100].value_counts(), 10)
    assert len(held) <= 10 and held.sum() <= 1000
    assert 400 - 1000 / 11 <= held["hot"] <= 400


# ---------------------------------------------------------------- mixing
def test_mixing_targets_and_sums(spark, odd_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for table in (docs, odd_docs):
        rows = mixing.mix(table).collect()
        assert len(rows) == table.count()
        assert all(r.taken <= 2 * r.size for r in rows)
        by = {}
        for r in rows:
            by.setdefault(r.source, []).append(r)
        total = sum(r.size for r in rows)
        assert math.isclose(sum(v[0].target for v in by.values()), 1.5 * total)
        for v in by.values():
            assert sum(r.taken for r in v) == math.floor(v[0].target + 0.5)
            assert v[0].target <= 2 * v[0].source_size
        assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix(table.repartition(3)).collect()))
        mixed = mixing.mixed_documents(table)
        assert mixed.columns == table.columns
        times = [r.repeats + (r.extra > 0 and 2 * r.extra >= r.size) for r in rows]
        assert abs(mixed.count() - sum(times)) <= 1  # rows that repeat an id share theirs
    assert mixing.mix(empty(odd_docs)).count() == 0


# ---------------------------------------------------------------- SentencePiece
def test_pieces_equal_the_library(spark, odd_docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    texts = Counter((r.doc_id, *digests(model, r.text or "")) for r in docs.collect())
    for table_rows in (1 << 17, 50):
        assert Counter(map(tuple, pieces.token_digests(docs, table_rows=table_rows).collect())) == texts
    one = pieces.encode(odd_docs).where("doc_id = 11").first()
    assert one.ids == model.encode("é " * 50 + "Released under the MIT License.") and one.decoded == model.decode(one.ids)
    assert pieces.token_digests(empty(odd_docs)).count() == 0


def digests(model, text):
    ids = model.encode(text)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids))


def test_chunks_equal_whole_texts():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    tool, rng = pieces.Chunks.load(None), random.Random(5)
    alphabet = [*" ▁ab c\n\té　ﬁ\x00<s>。中文", "  ", "▁▁", "the", "</s>", "<0x0A>", "\U0001f600"]
    for _ in range(2000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 20)))
        found = pieces.chunks_of(text)
        own = tool.look_up(set(found), {})
        assert ",".join(own[w][1] for w in found) == ",".join(map(str, model.encode(text)))
        assert " ".join(own[w][2] for w in found) == model.decode(model.encode(text))


# ---------------------------------------------------------------- quality
def test_grades_hold_out(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = grading.train(docs, labels.where("doc_id % 4 <> 0"))
    assert (np.diff(model.thresholds) >= 0).all()
    held_out = grading.graded_labels(labels.where("doc_id % 4 = 0")).join(grading.grade(docs, model), "doc_id").collect()
    share = lambda g: np.mean([r.keep for r in held_out if r.grade == g])
    assert share(2) >= 0.95 and share(1) <= 0.3 and share(0) < 0.7
    graded = grading.grade(odd_docs, model)
    assert graded.count() == odd_docs.count() and graded.where("expected_grade is null").count() == 0
    assert grading.keep_good(odd_docs, model).columns == odd_docs.columns
    assert grading.train(docs, empty(labels)) is None
    assert grading.grade(odd_docs, None).where("not keep").count() == 0
    assert grading.grade(empty(odd_docs), model).count() == 0


def test_scores_are_features_times_weights():
    weights = np.random.default_rng(0).normal(size=(2 << grading.BITS) + 4)
    for text in ("", None, "a", "Hello hello world ###", LONG):
        index, value = grading.features(text)
        assert math.isclose(grading.score(text, weights), float(weights[index] @ value), rel_tol=1e-9, abs_tol=1e-9)


# ---------------------------------------------------------------- personal data
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and private.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_personal_data(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for table in (docs, odd_docs):
        texts = {r.doc_id: r.text for r in table.collect()}
        rows = private.find_personal_data(table).collect()
        assert len(rows) == table.count()
        for r in rows:
            base = brute_spans(texts[r.doc_id])
            assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, *_ in base) for x in private.BASE_KINDS)
            assert r.spans.startswith(",".join(f"{k}:{s}:{e}" for k, s, e in base))
    assert private.find_personal_data(empty(odd_docs)).count() == 0


def test_base_spans_match_the_patterns():
    rng = random.Random(2)
    alphabet = [*"a1.@-+ (9)_%b.5", "25", ".1.2.3", "4111111111111111", "+1 555 ", "@x.y"]
    for _ in range(20_000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 25)))
        assert [(k, *s) for k in private.BASE_KINDS for s in private.base_spans(text)[k]] == brute_spans(text)
    for hard in ("1" * 100_000, "a" * 100_000, "@" * 50_000, "1." * 50_000, "+1" + " " * 100_000):
        private.base_spans(hard)


def test_further_spans_avoid_base_spans():
    rng = random.Random(6)
    text = " ".join(rng.choice(("name Mr. Alan Smith", "078-05-1120", "(415) 555-2671", "a at b dot com", "word")) for _ in range(400))
    everything = private.further_spans(text, [])
    for _ in range(30):
        taken = [(a, a + rng.randint(1, 40)) for a in (rng.randrange(len(text)) for _ in range(rng.randint(0, 60)))]
        free = [f for f in everything if not any(f[1] < e and s < f[2] for s, e in taken)]
        got = private.further_spans(text, taken)
        assert not any(f[1] < e and s < f[2] for f in got for s, e in taken) and set(free) <= set(got)
    many = " ".join(["078-05-1120"] * 16_000)
    started = time.perf_counter()
    assert len(private.further_spans(many, [(12 * i, 12 * i + 3) for i in range(0, 16_000, 2)])) == 8_000
    assert time.perf_counter() - started < 2


def test_reliabilities_are_estimated():
    rng = np.random.default_rng(1)
    truth = rng.random(5000) < 0.6
    right = np.array([0.95, 0.8, 0.6])
    cast = np.where(rng.random((5000, 3)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    patterns, n = np.unique(cast, axis=0, return_counts=True)
    found, post = private.expectation_maximisation(patterns.astype(float), n.astype(float))
    assert found[0] > found[1] > found[2]
    assert post[(patterns == 1).all(1)][0] > 0.9 and post[(patterns == -1).all(1)][0] < 0.2


# ---------------------------------------------------------------- WARC packages
def test_archives_round_trip(spark):
    big = "<p>" + "é" * 2000
    rows = [(1, "u1", big), (7, "u7", big), (3, "u3\r\nX: y", big), (4, None, None), (5, "u", ""), (6, "u", "small"), (8, "u", "small"), (None, "n", big)]
    table = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    got = {r.page_id: r for r in archives.round_trip(table).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert got[i].record_type == ("revisit" if html == big and i != 7 else "response")
        assert got[i].refers_to == (7 if html == big and i != 7 else None)
    assert got[4].url is None and got[1].url == "u1"
    assert archives.round_trip(empty(table)).count() == 0


def test_zip64_directories_and_packages_without_index(tmp_path, monkeypatch):
    import zipfile

    records = [archives.build_record(i, f"u{i}", b"x" * i, hashlib.sha1(b"x" * i).hexdigest(), None) for i in range(5)]
    import gzip

    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    path = tmp_path / "p.wacz"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("note.txt", "n" * 300)
        z.writestr("archive/data.warc.gz", b"".join(gzip.compress(r) for r in records))
    blocks = list(archives.package_blocks(str(path), 400))
    assert sum(len(b["lengths"]) for b in blocks) == 5 and len(blocks) > 1
    with zipfile.ZipFile(tmp_path / "q.wacz", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc", "x" * 100)
    with pytest.raises(ValueError, match="compressed"):
        list(archives.package_blocks(str(tmp_path / "q.wacz")))


# ---------------------------------------------------------------- page text
def test_main_text_of_markup():
    cases = {
        "<div class=content><p>a &amp; b<p>c<ul><li>x<li>y</ul></div>": ["a & b", "c", "x", "y"],
        "<article><header><h1>T</h1></header><p>x<b>y</b>z</p><div class='comments'><p>no</p></div><nav>m</nav>in <i>a</i> line"
        "<br>more<section><p>q</section></article><footer>f</footer>": ["T", "xyz", "in a line more", "q"],
        "<table><tr><td>1<td>2<tr><td>3</table>": ["1", "2", "3"],
        "<script>var t='</p>';</script><p><b>one<br><p>two": ["one", "two"],
        "": [],
    }
    for html, blocks in cases.items():
        assert pages.page_parts(html)[0] == blocks
    assert pages.page_parts(None)[0] == []
    assert pages.page_parts("<div>" * 5000 + "deep")[0] == ["deep"]


def test_templates_are_removed_and_articles_kept(spark):
    site = "<div><span>Our site</span> is great</div><article><p>{}</p><div>Buy now</div></article><div>All rights</div>"
    rows = [(i, f"https://h.example/{i}", site.format(f"Text {i % 2}")) for i in range(10)]
    rows += [(20, "https://other.example/x", "<div>Our site is great</div>"), (21, None, None), (22, "https://h.example/e", "")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int")
    got = {r.page_id: r for r in pages.main_text(table).collect()}
    assert [got[i].text for i in range(10)] == [f"Text {i % 2}" for i in range(10)]
    assert got[20].text == "Our site is great" and got[21].text == "" and got[22].n_chars == 0
    assert pages.main_text(empty(table)).count() == 0


def test_recurring_prose_inside_articles_is_removed(spark):
    site = "<nav>Home</nav><article><h1>T{0}</h1><p>Own text {0}</p><p>Get our weekly letter</p><ul><li>Tips<li>Jobs</ul></article><p>Legal</p>"
    rows = [(i, f"https://h.example/{i}", site.format(i)) for i in range(12)]
    rows += [(20, "https://other.example/x", "<article><p>Get our weekly letter</p></article>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(table).collect()}
    assert got == {**{i: f"T{i}\nOwn text {i}" for i in range(12)}, 20: "Get our weekly letter"}
    # nav, main element and the blocks in and after it are hashed, the notice among them
    assert len(pages.page_parts(site)[2]) == 9


def test_copied_articles_are_content(spark):
    wrapped = "<div>Site menu</div><article><div><h1>{0}</h1><p>Body of {0}</p></div></article>"
    bare = "<div>Site menu</div><div><h1>{0}</h1><p>Body of {0}</p></div><div>All rights</div>"
    for site in (wrapped, bare):  # one article on 6 of a host's 16 pages
        titles = ["Copied" if i < 6 else f"Own {i}" for i in range(16)]
        rows = [(i, f"https://h.example/{i}", site.format(t)) for i, t in enumerate(titles)]
        rows += [(100 + i, None, site.format(t)) for i, t in enumerate(titles)]
        table = spark.createDataFrame(rows, "page_id long, url string, html string")
        got = {r.page_id: r.text for r in pages.main_text(table).collect()}
        assert got == {k + i: f"{t}\nBody of {t}" for k in (0, 100) for i, t in enumerate(titles)}


def test_versions_of_an_article_are_content(spark):
    site = "<nav>Home</nav><article><h1>{0}</h1><p>First paragraph of {0}.</p><p>{1}</p><p>The last paragraph of {0}.</p><p>Get our letter</p></article>"
    titles = [("Shared story", f"Edition {i}, with a longer paragraph that is its own.") for i in range(8)] + [(f"Own {i}", "Text.") for i in range(12)]
    rows = [(i, f"https://h.example/{i}", site.format(*t)) for i, t in enumerate(titles)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(table).collect()}
    for i, (title, own) in enumerate(titles):
        kept = [title, f"First paragraph of {title}.", own, f"The last paragraph of {title}."]
        # on 12 of 13 articles the same short text recurs, like the notice
        assert got[i].split("\n") == [b for b in kept if b != "Text."], got[i]


def test_classes_within_an_article_are_hints():
    kept = "<article><h1>T</h1><div class='related-work'><p>Work.</p></div><p class='notice'>Notice that</p><div class='share-price'>Price</div>{}</article>"
    cases = {
        "<p>See <label>the label</label> and <button>the button</button>.</p>": ["See the label and the button."],
        "<dialog open>Said.</dialog><dialog>Hidden.</dialog>": ["Said."],
        "<div class='comments'>no</div><div class='post-share-buttons x'>no</div><ul class='related_posts'><li>no</ul><section class='widget'>no</section>": [],
        "<form><label>Mail</label><button>Send</button></form><button>Top</button><aside>Side</aside>": [],
        "<span class='ad'>word</span><td class='menu'>cell": ["word", "cell"],
    }
    for html, blocks in cases.items():
        assert pages.page_parts(kept.format(html))[0] == ["T", "Work.", "Notice that", "Price", *blocks], html


def brute_templates(rows):
    """Templates by host from the parts of each page, counted plainly."""
    hosts, found = {}, {}
    for host, html in rows:
        parts = pages.page_parts(html)
        hosts.setdefault(host, []).append((dict(zip(parts[2], parts[3], strict=True)), parts[4]))
    for host, held in hosts.items():
        articles = len({a for _, a in held if a})
        for h in {h for subtrees, _ in held for h in subtrees}:
            on = [subtrees[h] for subtrees, _ in held if h in subtrees]
            if len(on) >= 5 and len(set(on)) > 1 and len(set(on)) >= min(5, articles) and len(set(on)) >= 0.3 * articles:
                found.setdefault(host, set()).add(h)
    return found


def test_template_counts_equal_plain_ones(spark):
    rng = random.Random(9)
    blocks = ["<p>Notice {}</p>", "<div><p>A {}</p><p>B {}</p></div>", "<ul><li>x {}</li></ul>"]
    rows = []
    for i in range(120):
        host = f"h{rng.randint(0, 3)}.example"
        common = "".join(rng.choice(blocks).replace("{}", str(rng.randint(0, 1))) for _ in range(rng.randint(0, 3)))
        own = f"<h1>Title {rng.randint(0, 25)}</h1><p>Text {rng.randint(0, 40)} and more of it</p>"
        rows.append((i, f"https://{host}/{i}", f"<div>{common}</div><article>{own}{common}</article>" if i % 4 else f"<div>{own}{common}</div>"))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {}
    for r in pages.templates(pages.parse_pages(table, "page_id", "url", "html")).collect():
        got.setdefault(r.host, set()).add(r.subtree)
    assert got == brute_templates([(u.split("/")[2], h) for _, u, h in rows]) and got


def test_every_article_of_the_table(spark):
    import html as h

    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in pages.main_text(table).collect()}
    for r in table.collect():
        body = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        blocks = [" ".join(h.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?p>|</?h1>", body)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


# ---------------------------------------------------------------- licenses
def test_licenses(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    full = dict(licenses.TEMPLATES)["MIT-text"]
    more = spark.createDataFrame([(-1, "a b " * 300 + full.upper()), (-2, " ".join(full.split()[:40]))], "doc_id long, text string")
    docs = docs.union(more)
    got = {(r.doc_id, r.license_id) for r in licenses.scan(docs).collect()}
    expected = set()
    for r in docs.collect():
        held = plain_shingles(r.text or "")
        for name, template in licenses.TEMPLATES:
            wanted = plain_shingles(template)
            if len(wanted & held) >= 0.8 * len(wanted):
                expected.add((r.doc_id, name))
    assert got == expected and (-1, "MIT-text") in got and (-2, "MIT-text") not in got
    assert licenses.scan(empty(docs)).count() == 0
    assert licenses.scan(docs, templates=()).count() == 0


def test_related_licenses_are_told_apart(spark):
    known = dict(licenses.STANDARD)
    names = ["GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0", "GPL-2.0-header", "GPL-3.0-header", "AGPL-3.0-header", "BSD-2-Clause-full"]
    names += ["BSD-3-Clause-full", "MIT-full", "ISC-full", "CC-BY-4.0", "CC-BY-SA-4.0-notice", "Unlicense", "CC0-1.0"]
    texts = {n: known[n] for n in names}
    texts["both"] = known["GPL-2.0"] + " word" * 60 + known["GPL-3.0"]
    docs = spark.createDataFrame([(n, "some words before it " + t + " and some after") for n, t in texts.items()], "doc_id string, text string")
    got = {}
    for r in licenses.scan(docs).collect():
        got.setdefault(r.doc_id, set()).add(licenses.license_of(r.license_id))
    assert got == {**{n: {licenses.license_of(n)} for n in names}, "both": {"GPL-2.0", "GPL-3.0"}}


def plain_shingles(text):
    found = re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} - {()}


def test_license_plans_have_no_python(spark):
    from tests.helpers import plan_text

    plan = plan_text(licenses.scan(spark.read.parquet(f"{SF}/documents.parquet")))
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- top k
def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=16).round(2)]) for i in range(300)]
    rows += [(300, rows[7][1]), (301, rows[7][1]), (301, rows[7][1]), (302, None), (303, [1.0, None] * 8), (304, [float("nan")] * 16)]
    rows += [(400, [1.0]), (401, [2.0]), (None, [1.0])]
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, score int")
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in dict(rows).items() if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    expected = set()
    for q, v in good:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))
            expected |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])}
    for block in (64, 2048):
        assert {tuple(r) for r in topk.top_k(table, F.expr("vec_id % 50 = 0"), block=block).collect()} == expected
    assert topk.top_k(empty(table), F.expr("vec_id % 50 = 0")).count() == 0


def test_candidate_blocks_are_written_before_the_search(spark):
    from tests.helpers import plan_text

    table = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(60)], "vec_id long, embedding array<double>")
    found = topk.top_k(table, F.expr("vec_id % 50 = 0"))
    # blocks packed within the plan would be packed again, in another order, by a repeated task
    assert len(re.findall(r"(?m)^\(\d+\) MapInArrow", plan_text(found))) == 1


def brute_top_k(queries, rows, k=5):
    """``(query id, rank, id, score)``; an id counts once, by its best vector."""
    found = set()
    for q in {i for i, _ in queries}:
        best = {}
        for _, v in (x for x in queries if x[0] == q):
            for i, w in rows:
                if i != q and len(w) == len(v):
                    best[i] = max(best.get(i, -(2**70)), sum(int(a) * int(b) for a, b in zip(v, w, strict=True)))
        found |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted((-s, i) for i, s in best.items())[:k])}
    return found


def test_top_k_broadcasts_no_query_blocks(spark):
    from tests.helpers import plan_text

    table = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(60)], "vec_id long, embedding array<double>")
    held = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found = topk.top_k(table, F.expr("vec_id % 50 = 0"))
            # the planner took the query blocks' files for the size of their copies, one to each of
            # the shuffle partitions, and the driver collected all of those
            assert "Broadcast" not in plan_text(found)
            assert found.count() == 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_top_k_in_many_cells(spark, monkeypatch):
    rng = np.random.default_rng(14)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(2)]) for i in range(400)]
    rows += [(i, [0.5] * 6) for i in range(400, 520)]  # one common vector
    rows += [(i, [float(i), 3.0]) for i in range(600, 640)]
    rows += [(7, [2.0] * 6), (7, [1.9] * 6), (7, [1.8] * 6), (20, [-1.0] * 6)]  # ids with several vectors
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    expected = brute_top_k([x for x in good if x[0] % 10 == 0], good)
    seen = []
    monkeypatch.setattr(topk, "grid", lambda blocks, f=topk.grid: seen.append(f(blocks)) or seen[-1])
    for held, work in ((topk.HELD, topk.CELL_WORK), (3000, 1 << 14)):
        monkeypatch.setattr(topk, "HELD", held)
        monkeypatch.setattr(topk, "CELL_WORK", work)
        assert {tuple(r) for r in topk.top_k(table, F.expr("vec_id % 10 = 0"), block=16).collect()} == expected
    assert seen[0] == (1, 1) and min(seen[1]) > 1


@pytest.mark.parametrize("scale", [30, 1e5, 1e7, 2e8])
def test_block_search_is_exact(scale):
    rng = np.random.default_rng(15)
    rows = (rng.normal(size=(700, 12)) * scale).astype(np.int64)
    rows[100:200] = rows[5]  # ties
    rows[200:260] *= 3  # bounds spare most pairs with the others
    ids = rng.permutation(700)
    ids[300:320] = ids[299]  # an id with several vectors
    search = topk.BlockSearch(ids[:40], rows[:40], 5)
    for at in np.array_split(rng.permutation(700), 9):
        search.add(ids[at], rows[at])
    q, found, scores = search.found()
    ranks = np.concatenate([np.arange(n) + 1 for n in np.unique(q, return_counts=True)[1]])
    got = set(zip(q.tolist(), ranks.tolist(), found.tolist(), scores.tolist(), strict=True))
    assert got == brute_top_k(list(zip(ids[:40].tolist(), rows[:40], strict=True)), list(zip(ids.tolist(), rows, strict=True)))


def test_block_search_refuses_scores_beyond_a_long():
    for sign in (1, -1):
        search = topk.BlockSearch(np.array([1]), np.full((1, 4), 2**62), 5)
        with pytest.raises(OverflowError):
            search.add(np.array([2]), np.full((1, 4), sign * 2**62))
            search.found()


def test_bounds_are_above_products():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(50, 30)) * 256, rng.normal(size=(60, 30)) * 256
    for segments in topk.LEVELS:
        bound = topk.segment_statistics(a, segments) @ topk.segment_statistics(b, segments).T
        assert (bound + 1e-6 >= a @ b.T).all()


# ---------------------------------------------------------------- Jaccard join
def brute_components(rows):
    sets = [(i, plain_words(t)) for i, t in rows]
    low = {j: j for j in range(len(sets))}

    def root(j):
        while low[j] != j:
            j = low[j]
        return j

    for j, (_, a) in enumerate(sets):
        for k in range(j):
            b = sets[k][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low[root(j)] = root(k)
    best = {}
    for j, (i, _) in enumerate(sets):
        if i is not None:
            best[root(j)] = min(best.get(root(j), i), i)
    return Counter((i, len(s), best.get(root(j), i)) for j, (i, s) in enumerate(sets))


def plain_words(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} - {()}


def test_jaccard_components(spark, odd_docs):
    rng = random.Random(9)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for family in range(6):  # families of near copies of very different lengths
        base = [f"f{family}w{rng.randint(0, 500)}" for _ in range(rng.choice([5, 6, 8, 30, 120, 400]))]
        for copy in range(rng.choice([3, 12, 40])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                text[rng.randrange(len(text))] = f"edit{rng.randint(0, 5)}"
            rows.append((1000 * (family + 1) + copy, " ".join(text)))
    docs = spark.createDataFrame([(*r, b"k") for r in rows], "doc_id long, text string, key binary").repartition(4)
    assert Counter(map(tuple, jaccard.components(docs).collect())) == brute_components(rows)
    assert jaccard.components(empty(docs)).count() == 0
    kept = jaccard.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 4, 5, 6, 7, 10, 11}


def test_long_lists_and_their_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 8)  # several blocks per list, and hot lists
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(60)] = f"e{rng.randint(0, 400)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, jaccard.components(docs).collect())) == brute_components(rows)


def test_subsets_and_prefixes_meet_exactly_when_sets_link():
    rng = random.Random(12)
    for _ in range(300):
        n = rng.randint(1, 9)
        a = rng.sample(range(12), n)
        b = rng.sample(range(12), rng.randint(1, 9))
        shared = len(set(a) & set(b))
        link = jaccard.linked(shared, len(a), len(b))
        assert link == (shared >= jaccard.needed_overlap(len(a), len(b)))
        x, y = (np.array(sorted(v), np.uint64) for v in (a, b))
        common = set(jaccard.subset_tokens(x, 9)) & set(jaccard.subset_tokens(y, 9))
        assert link == any(c >= jaccard.needed_overlap(len(a), len(b)) for _, c in common)
        assert not link or jaccard.may_link(len(a), jaccard.parity_bitmap(x), len(b), jaccard.parity_bitmap(y))


def test_boundary_follows_the_cost():
    assert jaccard.choose_boundary({}) == 0
    assert jaccard.choose_boundary({3: 1000}) >= 3
    assert jaccard.choose_boundary({16: 1000, 15: 1000}) < 15


def test_near_copies_go_by_id_and_text(spark):
    near = BASE.split()
    other = " ".join(f"other{i}" for i in range(40))
    own = [" ".join(f"own{k}w{i}" for i in range(30)) for k in range(4)]
    rows = [(1, BASE), (None, BASE + "once more"), (None, own[0]), (None, own[1]), (None, None)]  # null ids, one near copy
    rows += [(7, " ".join(near[:-1])), (7, own[2])]  # a repeated id, one near copy
    rows += [(None, other), (None, other + " end"), (5, own[3]), (5, own[3] + " end"), (5, own[3].upper())]  # near copies of one id
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(map(tuple, jaccard.drop_near_copies(docs).collect()))
    single = Counter([(1, BASE), (None, own[0]), (None, own[1]), (None, None), (7, own[2])])
    assert single - kept == Counter() and kept.total() == 7
    assert sum(n for (i, t), n in kept.items() if i == 5) == 1
    assert sum(n for (i, t), n in kept.items() if i is None and t and t.startswith("other0")) == 1


def test_mixture_of_rows_that_share_an_id(spark):
    rows = [(None, f"{s} " * n, s) for s, n in (("a", 9), ("a", 4), ("b", 50), ("c", 200), ("c", 90), ("c", 30))]
    rows += [(1, "a " * 20, "a"), (2, "same text", "c"), (2, "same text", "c"), (2, "same text", "c"), (3, "c " * 500, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.mix(docs, budget=0.8).collect()
    expected = Counter()  # sizes tell the texts of an id and source apart here
    for r in taken:
        expected[(r.doc_id, r.source, r["size"])] += r.repeats + (r.extra > 0 and 2 * r.extra >= r["size"])
    got = Counter((r.doc_id, r.source, len(r.text.split())) for r in mixing.mixed_documents(docs, budget=0.8).collect())
    assert got == +expected and len({n for (i, *_), n in expected.items() if i is None}) > 1
