"""Nulls, empty and long texts, repeats, empty tables and clashing columns: every operator and stage has a defined result."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from affinora.llm import decontaminate, language, licenses, minhash, mixing, pseudolikelihood, rollups, subspace, toxicity, wrappers

LONG = " ".join(f"word{k}" for k in range(30_000))
NEAR = " ".join(f"alpha{k}" for k in range(60))
ROWS = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "b"), (4, "!!! ... 123", "de", "b"), (5, LONG, "en", "a"), (6, NEAR, "en", "a"),
    (7, NEAR + " end", "en", "a"), (7, NEAR + " end", "en", "a"), (8, NEAR, None, None), (None, "some text here now it is", "fr", "c"), (9, "two words", "en", "a"), (10, "two words", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = ["n_chars", "score", "kept", "component_id", "size", "position", "labels", "hits", "node", "key", "digest", "lower", "norm", "place", "bucket", "toxic", "block", "p", "s", "a", "b"]


def clash(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


@pytest.fixture(scope="module")
def docs(spark):
    return clash(spark.createDataFrame(ROWS, SCHEMA)).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return clash(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="module")
def labels(spark):
    return clash(spark.createDataFrame([(5, 0), (6, 1), (6, 0), (None, 1), (9, None), (99, 1)], "doc_id long, toxic int"))


def by_id(df):
    return sorted(df.collect(), key=lambda r: (r[0] is None, r[0] or 0))


def test_near_duplicates(docs, none):
    rows = by_id(minhash.near_duplicates(docs, 85))
    assert [(r.doc_id, r.component_id, r.kept) for r in rows] == [
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True), (7, 6, False), (7, 6, False), (8, 6, False), (9, 9, True), (10, 9, False), (None, None, True)]
    assert [r.n_shingles for r in rows] == [0, 0, 0, 1, 29_996, 56, 57, 57, 56, 1, 1, 2]
    assert minhash.near_duplicates(none).collect() == []
    assert sorted(r.doc_id or 0 for r in minhash.keep_one(docs).collect()) == [0, 1, 2, 3, 4, 5, 6, 9]


def test_one_id_with_several_texts(spark):
    rows = [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "h i j k l m n"), (3, "a b c d e f g"), (4, "q r s t u v w")]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85)
    assert {(r.doc_id, r.component_id) for r in out.collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_one_id_ties_two_classes(spark):
    a, b, c = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    rows = [(1, a), (2, b), (5, a), (5, b), (6, c), (7, c + " " + a + " " + b)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85)
    assert sorted({(r.doc_id, r.component_id) for r in out.collect()}) == [(1, 1), (2, 1), (5, 1), (6, 6), (7, 7)]


def test_mixing(docs, none):
    rows = by_id(mixing.mixed(docs))
    assert len(rows) == len(ROWS)
    assert all(r.taken == 0 and r.position is None for r in rows if r["size"] == 0)
    assert all(0 <= r.taken <= 2 * r["size"] and r.target <= 2 * r.source_size for r in rows)
    assert mixing.mixed(none).collect() == [] and mixing.curriculum(none).collect() == []


def test_wrappers(spark):
    pages = spark.createDataFrame([
        (1, None, None), (2, "http://h/x", ""), (3, "http://h/x", "<p>only"), (3, "http://h/x", "<p>only"), (4, "odd", "a < b & c <p"), (None, "http://h", "<!-- open <p>x"),
        (5, "http://h", "<p>" + "x " * 200_000 + "<script>never closed <p>y")], "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("host", F.lit("y"))
    rows = {r.page_id: r for r in wrappers.extract(pages).collect()}
    assert rows[1].text == rows[2].text == rows[None].text == "" and rows[3].text == "only" and rows[4].text == "a < b & c"
    assert rows[5].n_chars == 399_999
    assert wrappers.extract(pages.limit(0)).collect() == []


def test_contamination(spark, docs, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, NEAR), (3, NEAR), (4, "two words"), (None, "some text here now it is")], "item_id long, text string")
    rows = by_id(decontaminate.contamination(docs, items))
    assert [(r.doc_id, r.n_items) for r in rows] == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 0), (6, 2), (7, 2), (7, 2), (8, 2), (9, 1), (10, 1), (None, 1)]
    assert decontaminate.contamination(none, items).collect() == []
    assert decontaminate.contamination(docs, items.limit(0)).filter("contaminated").collect() == []


def test_pseudo_likelihood(docs, none):
    rows = by_id(pseudolikelihood.scores(docs))
    assert [r.n_tokens for r in rows] == [0, 0, 0, 3, 30_000, 60, 61, 61, 60, 2, 2, 6]
    assert all((r.mean_log_prob is None) == (r.n_tokens == 0) and r.log_prob <= 0 for r in rows)
    assert rows[6].log_prob == rows[7].log_prob
    assert pseudolikelihood.scores(none).collect() == []


def test_pseudo_likelihood_does_not_depend_on_a_text_s_place():
    """Matrix kernels may round by the place of a row; before, places differed with OPENBLAS_CORETYPE=Haswell and none did with SkylakeX."""
    random = np.random.default_rng(3)
    net = pseudolikelihood.Network(127)
    net.flat = net.flat + random.standard_normal(len(net.flat)).astype(np.float32) * np.float32(0.2)
    text = lambda n: pseudolikelihood._padded(random.integers(0, 127, n).astype(np.uint8), 127)
    one = text(61)
    alone = net.sequence_log_probs(one)
    for before in [*range(40), 1000, 16_000]:
        for after in (0, 1, 7):
            line = np.concatenate([text(before), one, text(after)])
            assert np.array_equal(net.sequence_log_probs(line)[before + 6:before + 67], alone)


def test_languages(docs, none):
    rows = by_id(language.languages(docs))
    assert [r.lang_pred == "und" for r in rows] == [True, True, True, True] + [False] * 8
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.languages(none).collect() == []
    assert {r.lang_pred for r in language.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_near_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 0.3]), (9, [1.0, 0.3]),
            (10, [0.0, 1.0]), (11, [1.0]), (None, [1.0, 0.0]), (12, [-1.0, 0.0]), (13, [1e-200, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("node", F.lit(1)).withColumn("raw", F.lit(1))
    out = by_id(subspace.near_vectors(frame))
    assert [(r.vec_id, r.n_links, r.component_id) for r in out] == [
        (1, 4, 1), (2, 4, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 4, 1), (9, 4, 1), (10, 0, 10), (11, 0, 11), (12, 0, 12), (13, 4, 1), (None, 0, None)]
    assert subspace.near_vectors(frame.limit(0)).collect() == []


def test_toxicity(docs, none, labels):
    rows = by_id(toxicity.scores(docs, labels))
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows}) == 1  # no hits anywhere
    assert toxicity.scores(none, labels).collect() == []
    assert len(toxicity.scores(docs, labels.limit(0)).collect()) == len(ROWS)


def test_licenses(docs, none):
    rows = by_id(licenses.scan(docs))
    assert [r.n_words for r in rows] == [0, 0, 0, 1, 30_000, 60, 61, 61, 60, 2, 2, 6]
    assert all(r.n_base == 0 and r.first_word is None and r.labels == "" and r.score == 0 for r in rows)
    assert licenses.scan(none).collect() == []


def test_rollups(spark, docs, none, labels, tmp_path):
    store = rollups.Store(spark, str(tmp_path / "s"))
    assert store.totals().collect() == []
    for batch, changes in rollups.document_changes(docs, labels):
        assert store.add(batch, changes)
    totals = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in store.totals().collect()}
    assert totals["a", "en", "words-1"] == (6, 30_000 + 2 * 61 + 2 + 2) and totals[None, None, "words-1"] == (1, 60)
    assert rollups.Store(spark, str(tmp_path / "e")).add("1", rollups.document_changes(none, labels)[0][1])


def test_pipeline_stages(spark, docs, none, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, NEAR), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for start in (docs, none):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, start, str(tmp_path))
            assert k == 4 or out.columns == start.columns
            assert out.count() <= start.count()
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 5, 9]


def test_misspelled_terms_under_a_stem(spark):
    rows = [(k, f"a{k} idiot b{k} idiots c{k} moronic d{k} moronish e{k}" if k % 2 else f"a{k} fine b{k} day c{k}", k % 2) for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = toxicity.fit(frame, frame).lexicon
    assert lexicon.read("idioten") == ("idio", 0) and lexicon.read("moronhood") == ("moro", 0)
    assert [lexicon.read(w) for w in ("idjot", "iidiot", "udiot", "idjots", "mohron")] == [("idiot", 1)] * 3 + [("idiots", 1), ("moron", 1)]
    same = toxicity.Lexicon({"idiot": 1.0}, {"idiot": 1.0})
    assert same.read("idiotic") == ("idiot", 0) and same.read("idjot") == ("idiot", 1)


def test_small_and_repetitive_items_are_always_found():
    items = [(k, " ".join(f"i{k}x{j}" for j in range(1 + k % 9))) for k in range(900)]
    items += [(900 + k, " ".join([f"r{k}"] * 40 + [f"r{k}y{j}" for j in range(1 + k % 8)])) for k in range(300)]
    index = decontaminate.Index(items, 80)
    texts = [t for _, t in items] + [f"f{k} g h " + t + f" p q{k}" for k, t in items]
    found = index.search(texts)
    for (k, t), alone, inside in zip(items, found, found[len(items):]):
        assert (k, 100.0) in alone
        assert ((k, 100.0) in inside) == (len(t.split()) >= 5)
    assert [index.search([t]) for t in texts[::7]] == [[f] for f in found[::7]]


def test_pages_keep_their_text():
    def texts(sources):
        host = wrappers.Host()
        for half in (sources[::2], sources[1::2]):
            part = wrappers.Host()
            for source in half:
                part.read(wrappers.Page(source))
            host.add(wrappers.Host.loads(part.dumps()))
        slots = host.main_slots()
        return [wrappers.main_text(source, slots) for source in sources]

    post = "<div class=top>Welcome</div><div class={}><p>{}</div>"
    assert texts([post.format("post", "same text")] * 4) == ["Welcome\nsame text"] * 4
    assert texts([post.format("post", f"text {k % 10}") for k in range(200)]) == [f"text {k % 10}" for k in range(200)]
    two = [("story" if k % 7 == 0 else "post", f"text number {k}") for k in range(100)]
    assert texts([post.format(*t) for t in two]) == [t for _, t in two]
    split = "<div class=a><p>{0}</div><div class=b><p>end {1}</div>"
    assert texts([split.format(f"{k} " * 40, k) for k in range(20)]) == [(f"{k} " * 40).strip() + f"\nend {k}" for k in range(20)]
    assert texts([post.format("post", f"text {k}") for k in range(20)] + ["<div class=top>Welcome</div><nav>x</nav>", "<nav>x</nav>"])[20:] == ["Welcome", ""]


def test_slots_by_the_expression(spark, monkeypatch):
    def texts(sources):
        host = wrappers.Host()
        for source in sources:
            host.read(wrappers.Page(source))
        slots = host.main_slots()
        return [wrappers.main_text(source, slots) for source in sources]

    # Template text inside an article goes where every page has it; remarks on some pages and values that recur stay.
    post = "<article><h1>T{0}</h1><p>word {0}<p>more {0}<div class=bio>About the author: Jane</div><div class=call>Ring us today</div>{1}<ul><li>{2}</ul></article>"
    pages = [post.format(k, "<div class=fix>Corrected</div>" if k % 3 == 0 else "", "yes" if k % 2 else "no") for k in range(20)]
    assert texts(pages) == [f"T{k}\nword {k}\nmore {k}" + ("\nCorrected" if k % 3 == 0 else "") + ("\nyes" if k % 2 else "\nno") for k in range(20)]
    # A heading before the article is its title if it has none, and isn't where it is the same everywhere.
    assert texts([f"<h1>Title {k}</h1><article><p>text {k}</article>" for k in range(9)]) == [f"Title {k}\ntext {k}" for k in range(9)]
    assert texts([f"<h1>Site</h1><article><p>text {k}</article>" for k in range(9)]) == [f"text {k}" for k in range(9)]
    assert texts(["<h1>Title</h1><article><p>text</article>"]) == ["Title\ntext"]
    # An apostrophe in a bare value quotes nothing; one after = does.
    assert texts(["<p data-x=it's>It is Bob's house and garden</p><p>second</p><p title='a>b' x = \"c>d\">third"]) == ["It is Bob's house and garden\nsecond\nthird"]
    # Weak names in an article: varying text stays, template text and what few pages show go.
    weak = "<article><p>text {0}</p><div class=legal><p>The court said {0}</div><div class=alert>Beware</div></article>"
    assert texts([weak.format(k) for k in range(9)]) == [f"text {k}\nThe court said {k}" for k in range(9)]
    assert texts([weak.format(1)]) == ["text 1"]
    # An article of template text alone keeps it.
    assert texts([f"<div>{k}</div><article><p>Closed</article>" for k in range(9)]) == ["Closed"] * 9
    # Classes alike in their first 40 characters are different slots.
    long = "c" * 40
    assert texts([f"<div class={long}x>text {k}</div><div class={long}y>Welcome</div>" for k in range(9)]) == [f"text {k}" for k in range(9)]
    # Slots too large to broadcast: salted, with the same rows.
    rows = spark.createDataFrame([(k, "http://h/x", p) for k, p in enumerate(pages)] + [(None, None, None)], "page_id long, url string, html string")
    small = wrappers.extract(rows).collect()
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", -1)
    assert sorted(map(str, wrappers.extract(rows).collect())) == sorted(map(str, small))


def test_late_batches_after_a_compaction(spark, tmp_path):
    store = rollups.Store(spark, str(tmp_path / "s"))
    one = spark.createDataFrame([("insert", "a", "en", "v1", 10, None)], "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long")
    for batch in ("2-x", "9-y", None, "1-late", "10-x", None):
        if batch:
            assert store.add(batch, one) and not store.add(batch, one)
        else:
            store.compact("9-y")
    assert [tuple(r) for r in store.totals().collect()] == [("a", "en", "v1", 4, 40)]
    store.compact("91")
    store._files().delete(store._path(f"{store.folder}/folded=upto-9-y"), True)
    assert [tuple(r) for r in store.totals().collect()] == [("a", "en", "v1", 4, 40)]
    with pytest.raises(ValueError):
        store.add("upto-1", one)
