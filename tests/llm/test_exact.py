"""Operators against brute force, exact round trips and held-out accuracy on small tables."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from oracle_check import compare, duck

from affinora.llm import catalog, decontaminate, language, licenses, minhash, mixing, pseudolikelihood, rollups, subspace, text, toxicity, wrappers
from affinora.llm.components import Forest, components


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLE) - {"op1_minhash_dedup"}))
def test_query_matches_oracle(spark, small, name):
    ok, why, _ = compare(catalog.QUERIES[name](spark, small), duck(small), catalog.ORACLE[name])
    assert ok, why


def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in catalog.QUERIES} == set(range(1, 14))


def _groups(rng, n_groups=6, copies=40):
    """Groups of copies with more and more words replaced, some so far that they link to a few members only."""
    out = []
    for g in range(n_groups):
        base = [f"g{g}w{k}" for k in range(120)]
        for c in range(copies):
            body = list(base)
            for k in rng.sample(range(120), rng.randrange(0, 8)):
                body[k] = f"x{g}{c}{k}" if rng.random() < 0.5 else f"y{g}{k}"
            out.append(" ".join(body))
    rng.shuffle(out)
    return list(enumerate(out))


def test_near_duplicates_against_all_pairs(spark):
    rows = _groups(random.Random(3))
    sets = [set(text.shingles(t).tolist()) for _, t in rows]
    forest = Forest()
    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
            forest.union(a, b)
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85)
    assert {r.doc_id: r.component_id for r in out.collect()} == {k: forest.find(k) for k, _ in rows}
    assert len({forest.find(k) for k, _ in rows}) > 6


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    for size, shared in ((3, 2), (40, 30), (500, 400)):
        errors = []
        for _ in range(60):
            x = np.unique(rng.integers(0, 1 << 63, 2 * size - shared, dtype=np.uint64))
            sig = minhash.super_minhash([x[:size], x[size - shared:]])
            errors.append((sig[0] == sig[1]).mean() - shared / (2 * size - shared))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07
    one = minhash.super_minhash([x])
    assert (np.sort(one >> np.uint64(48))[0] == np.sort(minhash.super_minhash([x, x[:3]])[0] >> np.uint64(48))).all()
    assert (minhash.super_minhash([x, x[:2]])[0] == one[0]).all()


def test_components_of_long_and_wide_graphs(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(300)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    rng.shuffle(edges)
    forest = Forest()
    for a, b in edges:
        forest.union(a, b)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert found == {k: forest.find(k) for e in edges for k in e if e[0] != e[1] or k in found}


def test_schedules_invert_their_integral(spark):
    for schedule in mixing.SCHEDULES:
        t = np.linspace(0, 1, 20_001)
        w = np.interp(t, schedule.knots, schedule.weights)
        demand = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)])
        demand /= demand[-1]
        shares = spark.createDataFrame([(float(x),) for x in np.linspace(0, 1, 101)], "x double")
        for r in shares.select("x", schedule.position(shares["x"]).alias("t")).collect():
            assert abs(np.interp(r.t, t, demand) - r.x) < 1e-3


def test_curriculum_is_the_mix(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    order = mixing.curriculum(docs).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    taken = {}
    for r in order:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.words
    rows = mixing.mixed(docs).collect()
    assert all(taken.get(r.doc_id, 0) == r.taken for r in rows)
    assert mixing.mixed(docs.repartition(7)).exceptAll(mixing.mixed(docs)).isEmpty()


LAYOUTS = [
    "<html><head><title>t</title><style>p{{}}</style></head><body><header>Site</header><nav><ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul></nav><article><h1>{h}</h1><p>{a}<p>{b}</p>"
    "<div class='ad-slot'>Buy</div><section id=comments><p>Nice!</p></section></article><aside>Side {n}</aside><footer>&copy; x</footer></body></html>",
    "<body><div class=menu><a href=1>One</a> <a href=2>Two</a></div><div class='top'>Welcome to the site</div><div id='page-{n}'><div class=body><h2>{h}</h2><div>{a}</div><div>{b}<br>more</div></div>"
    "<form><label>Mail</label><input></form><div class='cookie-notice'>We use</div></div><div>All about us</div><script>if (a<b) x('</p>')</script>",
]


def test_wrappers_find_main_text(spark):
    pages, want = [], {}
    for n in range(60):
        k = n % 2
        h, a, b = f"Title {n} &amp; more", f"First  part\n{n} " + "word " * (n % 7 + 20), f"Second <b>part</b> {n * n} " + "text " * 20
        pages.append((n, f"http://host{k}.example/{n}", LAYOUTS[k].format(h=h, a=a, b=b, n=n)))
        blocks = [f"Title {n} & more", " ".join(a.split()), " ".join(re.sub("<.*?>", "", b).split()) + (" more" if k else "")]
        want[n] = "\n".join(blocks)
    out = wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5))
    for r in out.collect():
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)


def test_wrapper_expressions():
    read = lambda s: wrappers.of_tree(wrappers.Page(s).root)
    one, two = read("<div><h1>x</h1><p>a<p>b</div><hr><div class=ad>q</div>"), read("<div><h1>y</h1><ul><li>1<li>2</ul><p>c</div>")
    assert wrappers.expression(wrappers.merge(one, two)) in (
        "<div><h1>#</>(<p>#</>)*(<ul>(<li>#</>)+</>)?</>(<div.ad>#</>)?", "<div><h1>#</>(<ul>(<li>#</>)+</>)?(<p>#</>)+</>(<div.ad>#</>)?")
    assert wrappers.expression(read("<dl><dt>a<dd>b<dt>c<dd>d</dl>")) == "<dl>(<dt>#</><dd>#</>)+</>"
    merged = wrappers.merge(one, two)
    assert wrappers.merge(merged, one) == merged and wrappers.merge(merged, two) == merged


def test_containment_in_long_documents(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [(k, " ".join(word() for _ in range(rng.randrange(6, 90)))) for k in range(60)]
    docs = []
    for n in range(120):
        body = [word() for _ in range(rng.choice((0, 50, 4000, 30_000)))]
        for k, item in rng.sample(items, 3):
            passage = item.split()
            if rng.random() < 0.5:
                passage[rng.randrange(len(passage))] = word()
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        docs.append((n, " ".join(body)))
    sets = {k: set(text.shingles(t).tolist()) for k, t in items}
    want = {}
    for n, body in docs:
        mine = set(text.shingles(body).tolist())
        want[n] = ",".join(map(str, sorted(k for k, s in sets.items() if 100 * len(s & mine) >= 80 * len(s))))
    out = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: r.item_ids for r in out.collect()} == want


def test_item_blocks_agree(spark, small, monkeypatch):
    docs, items = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/benchmark.parquet")
    whole = decontaminate.contamination(docs, items).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)
    assert sorted(decontaminate.contamination(docs, items).collect()) == sorted(whole)


def test_network_gradient_and_score():
    rng = np.random.default_rng(2)
    size = pseudolikelihood.WORDS + pseudolikelihood.ENDINGS + pseudolikelihood.LENGTHS
    net = pseudolikelihood.Network(size)
    net.flat = net.flat.astype(np.float64)
    ids = rng.integers(0, size, 50)
    around = pseudolikelihood.windows(ids, size, np.arange(50))
    assert around[10].tolist() == [*ids[7:10], *ids[11:14]] and around[0].tolist() == [size] * 3 + [*ids[1:4]]
    g = net.gradient(around, ids)
    for k in rng.choice(len(net.flat), 40, replace=False):
        old = net.flat[k]
        net.flat[k] = old + 1e-5
        up = -net.log_probs(around, ids).mean()
        net.flat[k] = old - 1e-5
        down = -net.log_probs(around, ids).mean()
        net.flat[k] = old
        assert abs((up - down) / 2e-5 - g[k]) < 1e-6
    embed, w1, b1, w2, b2 = net.parts(net.flat)
    total = 0.0
    for t in range(50):
        z = np.tanh(np.concatenate([embed[c] for c in around[t]]) @ w1 + b1) @ w2 + b2
        total += z[ids[t]] - np.log(np.exp(z).sum())
    assert math.isclose(pseudolikelihood.document_score(net, ids), total, rel_tol=1e-9)


def test_training_beats_word_frequencies(spark):
    rng = random.Random(1)
    lines = [(k, " ".join(rng.choice(("red fox runs", "blue cow eats")) for _ in range(40))) for k in range(2000)]
    docs = spark.createDataFrame(lines, "doc_id long, text string").coalesce(1)
    mixed_up = [(k, " ".join(rng.sample(t.split(), len(t.split())))) for k, t in lines[:100]]
    words = pseudolikelihood.vocabulary(pseudolikelihood.word_counts(docs))
    net = pseudolikelihood.fit(pseudolikelihood.read(docs, words), words.size)
    read = lambda t: np.frombuffer(words.reader().read([text.words(t)])[0][0], np.uint8)
    good = np.mean([pseudolikelihood.document_score(net, read(t)) for _, t in lines[:100]])
    bad = np.mean([pseudolikelihood.document_score(net, read(t)) for _, t in mixed_up])
    assert good / 120 > -0.7 and good > bad + 50


def _pseudo_likelihood_by_hand(net, words, counts: Counter, body: str) -> float:
    """Class by class from the neighbours, word by word from the counts, one token at a time."""
    tokens = body.lower().encode().split()
    of = lambda some: words.classes(some, pseudolikelihood.word_ids(some)).tolist()
    cls = of(tokens)
    in_class = Counter()
    for c, n in zip(of(list(counts)), counts.values()):
        in_class[c] += n
    embed, w1, b1, w2, b2 = net.parts(net.flat.astype(np.float64))
    padded = [words.size] * 3 + cls + [words.size] * 3
    total = 0.0
    for k, t in enumerate(tokens):
        around = padded[k:k + 3] + padded[k + 4:k + 7]
        z = np.tanh(np.concatenate([embed[c] for c in around]) @ w1 + b1) @ w2 + b2
        total += z[cls[k]] - np.log(np.exp(z).sum()) + math.log(counts[t] / in_class[cls[k]])
    return total


def test_pseudo_likelihood_by_definition(spark):
    """Whole result, with words looked up in the table and words joined by their counts."""
    rng = random.Random(5)
    stems = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in ("n", "ter", "sing", "ly", "ción", "st")]
    lines = [(k, " ".join(rng.choice(stems[:40] if rng.random() < 0.6 else stems) for _ in range(rng.randrange(1, 60)))) for k in range(300)]
    lines += [(300, "the senator of florida"), (301, "the senator of florida"), (302, "the xqzzwvk of bbbqqqz"), (303, None), (304, " ")]
    docs = spark.createDataFrame(lines, "doc_id long, text string").coalesce(2)
    counts = Counter(w for _, t in lines for w in text.words(t))
    tables = pseudolikelihood.word_counts(docs)
    for share in (1 << 20, 200):
        words = pseudolikelihood.vocabulary(tables, share)
        assert len(words.frequent) == sum(n * share >= sum(counts.values()) for n in counts.values())
        net = pseudolikelihood.fit(pseudolikelihood.read(docs, words), words.size)
        got = {r["doc_id"]: r for r in pseudolikelihood.scores(docs, share).collect()}
        assert len(got) == len(lines) and got[303]["log_prob"] == 0.0 and got[304]["mean_log_prob"] is None
        for k, body in lines[:40] + lines[-5:-2]:
            assert math.isclose(got[k]["log_prob"], _pseudo_likelihood_by_hand(net, words, counts, body), rel_tol=1e-4), k
        assert got[300]["log_prob"] == got[301]["log_prob"] != got[302]["log_prob"]


def test_garbled_words_score_lower(spark):
    """Documents with words of like lengths that nobody else uses, in each of four languages."""
    rng = random.Random(11)
    said = {
        "en": "the old captain walked slowly along the harbour wall and watched small boats return with fish".split(),
        "de": "der alte kapitän ging langsam am hafen entlang und sah den kleinen booten bei der heimkehr zu".split(),
        "fr": "le vieux capitaine marchait lentement sur le quai et regardait les petits bateaux revenir du large".split(),
        "es": "el viejo capitán caminaba despacio por el puerto y miraba los pequeños barcos volver con pescado".split(),
    }
    lines, garbled, k = [], {}, 0
    for lang, some in said.items():
        for _ in range(150):
            body = [w for _ in range(3) for w in some]
            at = rng.randrange(len(body))
            lines.append((k, lang, " ".join(body[at:] + body[:at])))
            if k % 15 == 0:
                odd = [w if len(w) < 6 else "".join(rng.choice("qxzwvkj") for _ in w) for w in body]
                garbled[k + 100_000] = k
                lines.append((k + 100_000, lang, " ".join(odd)))
            k += 1
    docs = spark.createDataFrame(lines, "doc_id long, lang string, text string").coalesce(2)
    got = {r["doc_id"]: r["mean_log_prob"] for r in pseudolikelihood.scores(docs).collect()}
    assert all(got[odd] < got[plain] - 0.5 for odd, plain in garbled.items())


def test_every_token_is_masked_once():
    """Over the rounds, each token of each document is a target once; long documents see across their pieces."""
    rng = np.random.default_rng(0)
    bodies = [rng.integers(0, 100, n).astype(np.uint8) for n in (0, 1, 5, 700, 64, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bodies], pa.binary())], names=["classes"])
    seen = []
    for line, places in pseudolikelihood._lines([batch], 127, 100):
        at = np.concatenate([places[k::pseudolikelihood.ROUNDS] for k in range(pseudolikelihood.ROUNDS)])
        seen += [tuple(line[p - 3:p + 4]) for p in sorted(at)]
    wanted = []
    for b in bodies:
        padded = [127] * 3 + b.tolist() + [127] * 3
        wanted += [tuple(padded[k:k + 7]) for k in range(len(b))]
    assert seen == wanted


def _ppm_bits(tails: dict, data: list, size: int) -> float:
    """Code length by the definition, one symbol at a time."""
    def share(context: tuple, symbol: int) -> float:
        seen = tails.get(context, {})
        lower = (lambda s: share(context[1:], s)) if context else (lambda s: 1.0 / size)
        if not seen:
            return lower(symbol)
        total, kinds = sum(seen.values()), len(seen)
        if kinds == size:
            return seen[symbol] / total
        if symbol in seen:
            return seen[symbol] / (total + kinds)
        return kinds / (total + kinds) * lower(symbol) / sum(lower(s) for s in range(size) if s not in seen)

    k = language.ORDER
    return sum(-math.log2(share(tuple(data[i - k:i]), data[i])) for i in range(k, len(data)))


def test_code_lengths_by_definition():
    counted = []
    texts = {"x": "abra cadabra abracad", "y": "banana bandana cabana ábd"}
    for lang, body in texts.items():
        code, n = np.unique(language.grams(language.read_bytes(body)), return_counts=True)
        counted += [(lang, int(c), int(k)) for c, k in zip(code, n)]
    trees = language.Trees(*(list(c) if k == 0 else np.array(c) for k, c in enumerate(zip(*counted))))
    for k, lang in enumerate(trees.langs):
        data = trees.symbol[language.read_bytes(texts[lang])].tolist()
        tails: dict = {}
        for i in range(language.ORDER, len(data)):
            for order in range(language.ORDER + 1):
                seen = tails.setdefault(tuple(data[i - order:i]), {})
                seen[data[i]] = seen.get(data[i], 0) + 1
        for body in ("abracadabra", "banana zebra", "é", "cab" * 40):
            coded = trees.symbol[language.read_bytes(body)].tolist()
            assert math.isclose(trees.code_lengths(["zz", body])[1, k], _ppm_bits(tails, coded, trees.size), rel_tol=1e-4)


def test_languages_held_out(spark, small):
    docs = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet")
    rows = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_vectors_against_all_pairs(spark, kind, monkeypatch):
    monkeypatch.setattr(subspace, "TILE", 64)
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((40, 20)) * rng.uniform(0.2, 2, 20)
    x = (centers[rng.integers(0, 40, 500)] + rng.standard_normal((500, 20)) * rng.choice([0.02, 0.2, 0.35], (500, 1))).astype(np.float32 if kind == "float" else np.float64)
    x[50:60], x[70] = x[10], x[10] * 4
    y = x.astype(np.float64)
    size = np.sqrt((y * y).sum(axis=1))
    near = y @ y.T / size[:, None] / size >= 0.9
    np.fill_diagonal(near, False)
    forest = Forest()
    for a, b in zip(*np.nonzero(near)):
        forest.union(int(a), int(b))
    out = subspace.near_vectors(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], f"vec_id long, embedding array<{kind}>"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in out.collect()} == {k: (int(near[k].sum()), forest.find(k)) for k in range(500)}


def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distances():
    rng = random.Random(6)
    terms = ["idiot", "disgusting", "scum", "moron", "worthless", "clown"]
    lexicon = toxicity.Lexicon({t: 1.0 for t in terms}, {"lowei": 1.0}, frozenset({"moran"}))
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randrange(2)] = rng.choice(["", "a", "o", "x"])
        word = "".join(word)
        near = [(d, t) for t in terms if (d := _edits(word, t)) <= toxicity.edits_allowed(t, False)]
        assert lexicon.read(word) == ((min(near)[1], min(near)[0]) if near and not (min(near)[0] and word == "moran") else None)
    assert lexicon.read("loweischaft") == ("lowei", 0) and lexicon.read("lowe") is None and lexicon.read("moran") is None
    assert lexicon.match("1d10t!!") == ("idiot", 0) and lexicon.match("\"stupid\"") is None


def test_quotation_weighs_less():
    model = toxicity.Model(toxicity.Lexicon({"idiot": 1.0}, {}))
    abuse, said, none = (model.score(t)[0] for t in ("you are an idiot and you know it", "he said the word \"idiot\" in court", "a fine day"))
    assert abuse > 0.5 > said > none


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.scores(docs, labels).join(labels, "doc_id").filter("held_out and toxic is not null").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.97
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.9


def _license_places(body: str | None):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in body or "")
    tokens = re.findall(licenses.WORD, lower)
    places = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(tokens)) if tokens[k:k + len(phrase.split())] == phrase.split()]
    norm, found = " " + " ".join(tokens) + " ", []
    for priority, label, _, regex, relevance in licenses.rules():
        for m in re.finditer(f"(?<= )(?:{regex})(?= )", norm):
            start = norm[:m.start()].count(" ") - 1
            found.append((start, start + m[0].count(" ") + 1, priority, label, relevance))
    kept = [d for d in found if not any(o[0] <= d[0] and o[1] >= d[1] and o[2] < d[2] for o in found)]
    return (len(tokens), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None), ",".join(sorted({x for _, x in places})),
            ",".join(sorted({x for _, x in places} | {d[3] for d in kept})), max([1.0 * bool(places), *(d[4] for d in kept)]))


def test_licenses_against_all_rules(spark, small):
    rng = random.Random(8)
    parts = ["under the MIT License", "licensed under the Apache License, Version 2.0", "CC-BY-NC 4.0", "cc by nc sa", "GNU Lesser General Public License v2.1", "GPL v3", "released under the",
             "BSD 3-Clause License", "new BSD license", "see the", "Mozilla Public License 2.0", "all rights reserved.", "is in the public\ndomain", "été", "word", "SPDX-License-Identifier: MIT License",
             "Permission is hereby granted, free of charge, to any person obtaining a copy", "Creative Commons Attribution-NonCommercial 4.0", "apache license version 20", "under  the mit licenses", "License: ISC", "MIT-licensed", "MPL-2.0", "simple example", "SPDX-License-Identifier: Zlib", "licensed under MPL 2.0"]
    rows = [(k, rng.choice((" ", ", ", "\n")).join(rng.choice(parts) for _ in range(rng.randrange(1, 12)))) for k in range(250)]
    rows += [(1000 + r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    out = {r.doc_id: tuple(r)[1:] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, body in rows:
        assert out[k] == _license_places(body), body
    assert len(licenses.rules()) > 300


def test_short_license_identifiers_and_long_texts(spark):
    bodies = {1: "SPDX-License-Identifier: MIT", 2: "License: MIT", 3: "an MIT-licensed tool", 4: "MPL-2.0", 5: "SPDX-License-Identifier: ISC", 6: "a simple mit example", 7: "x " * 200_000 + "cc by nc, under the MIT license " * 20_000}
    df = spark.createDataFrame(list(bodies.items()), "doc_id long, text string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            rows = {r.doc_id: r for r in licenses.scan(df if ansi == "true" else df.filter("doc_id < 7")).collect()}
            assert [(rows[k].labels, rows[k].n_base) for k in range(1, 7)] == [("mit", 0), ("mit", 0), ("mit", 0), ("mpl-2", 0), ("isc", 0), ("", 0)]
            if ansi == "true":
                assert (rows[7].n_base, rows[7].first_word, rows[7].last_word) == (40_000, 200_000, 200_000 + 7 * 20_000 - 4)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_rollups_are_idempotent_and_additive(spark, tmp_path):
    store = rollups.Store(spark, str(tmp_path / "store"))
    schema = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"
    first = spark.createDataFrame([("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None), ("insert", None, None, "v1", 7, None), ("odd", "a", "en", "v1", 99, None), ("insert", "a", "en", "v1", None, None)], schema)
    second = spark.createDataFrame([("delete", "a", "en", "v1", 5, None), ("revise", None, None, "v1", 9, 7)], schema)
    want = {("a", "en", "v1", 1, 10), (None, None, "v1", 1, 9)}
    assert store.add("1", first) and not store.add("1", second) and store.add("2", second) and not store.add("2", second)
    assert {tuple(r) for r in store.totals().collect()} == want
    # A batch that was cut off before its commit is not seen, and is written anew.
    first.write.parquet(f"{store.folder}/batch=3")
    store._files().delete(store._path(f"{store.folder}/batch=3/_SUCCESS"), False)
    assert {tuple(r) for r in store.totals().collect()} == want and store.batches() == ["1", "2"]
    assert store.add("3", second.limit(0))
    store.compact("2")
    store.compact("2")
    assert {tuple(r) for r in store.totals().collect()} == want
    store.add("4", first)
    assert {tuple(r)[3:] for r in store.totals().collect()} == {(3, 25), (2, 16)}


def test_vocabulary_file_counts(spark):
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    docs = spark.createDataFrame([(1, "Hello world, hello"), (2, None), (3, "")], "doc_id long, text string")
    assert [r[0] for r in docs.orderBy("doc_id").select(rollups.vocabulary_count(path, docs["text"])).collect()] == [4, 0, 0]


def test_item_blocks_in_turn(spark, monkeypatch):
    """Many blocks give what one block gives, with copies, nulls and clashing names; one index is alive at a time."""
    rng = random.Random(8)
    bodies = [" ".join(rng.choices(["ab", "cd", "ef", "gh", "ij", "kl", "mn"], k=rng.randrange(3, 60))) for _ in range(60)]
    items = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)] + [(7, bodies[9])], "item_id long, text string")
    rows = [(k % 90, " ".join([bodies[k % 60], "between"] * (k % 3) + ["zz"] * 9 + [bodies[(k * 7) % 60]])) for k in range(100)]
    rows += [(None, bodies[3]), (None, bodies[4]), (None, bodies[3]), (5, None), (6, "clean words only in this one")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, hits_0 string, DOC_0 string")
    answer = lambda: sorted(map(tuple, decontaminate.contamination(docs, items).collect()), key=str)
    clean = lambda: sorted(map(tuple, decontaminate.clean_documents(docs, items).collect()), key=str)
    whole, kept = answer(), clean()
    assert len(whole) == len(rows) and 0 < len(kept) < len(rows)
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 9)
    alive, made = [], decontaminate._search
    monkeypatch.setattr(decontaminate, "_search", lambda index: alive.append(index) or made(index))
    assert answer() == whole and clean() == kept
    assert len(alive) == 14
    for index in alive:
        with pytest.raises(Exception, match="destroyed"):
            index.destroy()
            made(index)


def test_automaton_is_bounded(monkeypatch):
    """On random words the automaton starts afresh at its bound, and answers stay the same."""
    rng = random.Random(2)
    word = lambda a, b: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(a, b)))
    terms = {word(5, 11): 1.0 for _ in range(120)}
    some = [word(3, 12) for _ in range(3000)] + ["x" * 5000, next(iter(terms)) * 200]
    free = toxicity.Lexicon(terms, {})
    expected = [free.match(w) for w in some]
    monkeypatch.setattr(toxicity, "KEPT", 2000)
    bounded, most = toxicity.Lexicon(terms, {}), 0
    for w, e in zip(some, expected):
        assert bounded.match(w) == e
        most = max(most, bounded.held)
    assert free.held > 20_000 > most and any(expected)


def test_second_readings_have_positions(spark, small):
    rows = catalog.op2_mix_sources(spark, small).collect()
    assert any(r.n_readings == 2 for r in rows)
    assert all((r.n_readings == 2) == (r.position != r.last_position) for r in rows if r.n_readings)
    assert all(r.n_readings == 2 for r in rows if r.taken > r["size"])


def test_language_stage_rejects_what_no_tree_explains(spark, small):
    """Junk and languages never learned go; documents of the learned ones stay, mixed scripts have symbols of their own."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    odd = ["これは日本語の文章です。今日は天気がいいですね。", "xkq vbn zzt qwr plm wxq bgt hhj kkl zxv qpd fgh",
           "Ten nowy dom stoi przy drodze i nikt w nim nie mieszka od wielu lat, bo dach przecieka", "12 34 -- 56", ""]
    rows = docs.unionByName(spark.createDataFrame([(10 ** 9 + k, x, None) for k, x in enumerate(odd)], docs.schema))
    kept = {r.doc_id for r in language.known_documents(rows).select("doc_id").collect()}
    assert not any(k >= 10 ** 9 for k in kept)
    with_letters = {r.doc_id for r in docs.collect() if language.has_letter(r.text)}
    assert len(with_letters - kept) <= len(with_letters) // 200
    learned = language.fit(spark.createDataFrame([(k, x, lang) for k, (x, lang) in enumerate([(odd[0] * 9, "ja"), ("доброе утро, как дела " * 9, "ru")] * 8)], docs.schema))
    assert learned.size - 1 == len(set(language.read_bytes(odd[0] + "доброе утро, как дела ").tolist()))
    assert [p[0] for p in learned.predict([odd[0], "как дела утро"])] == ["ja", "ru"]
