"""Fill-in-the-middle, repeated passages and the Merkle manifest against brute force, round trips and odd inputs."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinora.llm import infill, merkle, passages

DOCS = "doc_id long, text string, source string, lang string, n_chars long"
CLASH = ["key", "digest", "first", "kept", "mark", "tree", "rank", "h1", "output", "form", "restored", "node", "path", "_at", "_part"]


def frame(spark, rows):
    df = spark.createDataFrame([(d, t, s, "en", None if t is None else len(t)) for d, t, s in rows], DOCS).repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASH})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill in the middle


def lines_of(text):
    out = text.split("\n")
    return [x + "\n" for x in out[:-1]] + ([out[-1]] if out[-1] else [])


def infilled(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    units = lines_of(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 50:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD_TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "a\nb\nc", "a\nb\nc\n", "has <P> in it\nand more", "<", "<P", "P>\n<S", "ends with <\n<M", "äöü\n日本語\n🙂 x\n",
    "x\r\ny\r\n", "tail <S>", "\n" * 50, "long " * 3000 + "\n" + "line " * 3000]


def test_infill_against_definition(spark):
    rnd = random.Random(3)
    texts = ODD_TEXTS + ["".join(rnd.choice("ab<PSM>é🙂 \n\n") for _ in range(rnd.randrange(80))) for _ in range(300)]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(5, "a\nb\nc", "s"), (None, "no id\nhere", "s")]
    out = infill.restore(infill.transform(frame(spark, rows))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted(map(tuple, (r[:6] for r in out)), key=key) == sorted((infilled(d, t) for d, t, _ in rows), key=key)
    assert sorted((r.doc_id or -1, r.restored) for r in out) == sorted((d or -1, t or "") for d, t, _ in rows)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert infill.digests(frame(spark, rows).limit(0)).collect() == []


def test_infill_in_small_slices(monkeypatch):
    monkeypatch.setattr(infill, "SLICE", 7)
    rnd = np.random.default_rng(1)
    for _ in range(50):
        sizes = rnd.integers(0, 30, 6)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = rnd.integers(97, 123, offsets[-1]).astype(np.uint8)
        cuts = np.sort(rnd.integers(0, sizes + 1, (2, 6)), axis=0) + offsets[:-1]
        kind = rnd.integers(0, 3, 6)
        out, at = infill.scatter(data, offsets, *cuts, kind == 1, kind == 2)
        for k in range(6):
            p, m, s = (bytes(data[a:b]) for a, b in zip([offsets[k], *cuts[:, k]], [*cuts[:, k], offsets[k + 1]]))
            assert bytes(out[at[k]:at[k + 1]]) == [p + m + s, b"<P>" + p + b"<S>" + s + b"<M>" + m, b"<S>" + s + b"<P>" + p + b"<M>" + m][kind[k]]
        back, ends = infill.gather(out, at, kind == 1, kind == 2)
        assert bytes(back) == bytes(data) and (ends == offsets).all()


def test_infill_shares(spark):
    rows = [(k, "a\nb\nc\nd", "s") for k in range(2000)]
    forms = {r.form: r["count"] for r in infill.transform(frame(spark, rows), salt="x", percent=40, spm_percent=25).groupBy("form").count().collect()}
    assert 1100 < forms["plain"] < 1300 and 150 < forms["spm"] < 250 and 520 < forms["psm"] < 680


# ---- repeated passages


def without_repeats(rows):
    split = [(d, (t or "").encode().split()) for d, t, _ in rows]
    seen = {}
    for d, w in split:
        for i in range(len(w) - 49):
            if d is not None:
                seen[tuple(w[i:i + 50])] = min(d, seen.get(tuple(w[i:i + 50]), d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 49):
            if d is not None and seen[tuple(w[i:i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def planted(seed):
    rnd = random.Random(seed)
    shared = [[f"p{k}w{rnd.randrange(400)}" for _ in range(n)] for k, n in enumerate((49, 50, 51, 60, 93, 120, 300))]
    rows = []
    for d in rnd.sample(range(500), 120):
        words = []
        for _ in range(rnd.randrange(1, 5)):
            words += [f"w{rnd.randrange(50)}" for _ in range(rnd.randrange(40))]
            words += rnd.choice(shared)[:rnd.choice([1000, 1000, 55])] if rnd.random() < 0.8 else []
        if rnd.random() < 0.2 and words:
            words[rnd.randrange(len(words))] = "changed"
        rows.append((d, rnd.choice([" ", "  ", "\n"]).join(words), "s"))
    base = [f"c{rnd.randrange(90)}" for _ in range(200)]
    for d in range(600, 640):  # near copies of one document
        words = list(base)
        words[rnd.randrange(200)] = f"x{d % 7}"
        rows.append((d, " ".join(words), "s"))
    loop = " ".join(["la"] * 400)
    rows += [(700, loop, "s"), (701, loop + " end", "s"), (702, "start " + loop, "s"), (703, loop.upper(), "s"), (704, " ".join(["la", "di"] * 300), "s")]
    rows += [(rows[0][0], rows[1][1], "s"), rows[2], rows[2], (800, rows[2][1].replace(" ", "\n"), "s"), (None, base and " ".join(base), "s"), (900, None, "s"), (901, "", "s"), (902, " \t ", "s")]
    rows += [(903, "ä b " * 60, "s"), (904, "ä b " * 55, "s")]
    return rows


@pytest.mark.parametrize("hot", [2048, 2])
def test_passages_against_definition(spark, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "SHARD_WORDS", 3000)
    rows = planted(hot)
    docs = frame(spark, rows)
    assert sorted(map(tuple, passages.removed(docs).collect()), key=repr) == without_repeats(rows)


def test_kept_texts(spark):
    rows = planted(5)
    kept = passages.kept_texts(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    got = [(r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in kept.collect()]
    assert sorted(got, key=repr) == sorted(((d, s) for d, _, _, s in without_repeats(rows)), key=repr)
    assert passages.removed(frame(spark, rows).limit(0)).collect() == []


def test_index_against_definition():
    rnd = random.Random(1)
    for _ in range(200):
        symbols, width = rnd.choice([1, 2, 3, 8]), rnd.choice([1, 2, 3, 5])
        texts = [[rnd.randrange(symbols) for _ in range(rnd.randrange(1, 14))] for _ in range(rnd.randrange(1, 9))]
        first = [rnd.randrange(5) for _ in texts]
        found = passages.search([b" ".join(b"%d" % x for x in t) for t in texts], first, width)
        got = {(k, i) for k, a, b in found for i in range(a, b + 1)}
        want = {(k, i) for k, t in enumerate(texts) for i in range(len(t) - width + 1) if any(
            first[j] < first[k] and any(q[m:m + width] == t[i:i + width] for m in range(len(q) - width + 1)) for j, q in enumerate(texts))}
        assert got == want


# ---- Merkle manifest


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def up(nodes):
    """Levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k:k + 16])) for k in range(0, len(last), 16)])
    return levels


def siblings(levels, rank):
    out = []
    for level in levels[:-1]:
        run = rank // 16 * 16
        out.append((level[run:rank], level[rank + 1:run + 16]))
        rank //= 16
    return out


def audited(rows):
    groups = {}
    for d, t, s in rows:
        n = None if t is None else len(t)
        claimed = t if t is None or d is None or zlib.crc32(str(d).encode()) % 5 else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        leaf, other = (sha("".join(map(framed, (d, s, "en", n, x)))) for x in (t, claimed))
        groups.setdefault(s, []).append((d is not None, d or 0, leaf, other, d))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: up([x[2] for x in sorted(groups[s])]) for s in names}
    top = up([trees[s][-1][0] for s in names])
    out = []
    for g, s in enumerate(names):
        for rank, (_, _, leaf, other, d) in enumerate(sorted(groups[s])):
            steps = siblings(trees[s], rank) + siblings(top, g)
            acc = other
            for left, right in steps:
                acc = sha("".join(left) + acc + "".join(right))
            out.append((d, leaf, trees[s][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in steps)), acc, acc == top[-1][0]))
    return sorted(out, key=repr)


def manifest_rows(sizes):
    rows = [(100 * k + j, f"Text {j} Of {s}", s) for k, (s, n) in enumerate(sizes.items()) for j in range(n)]
    return rows + [(1, None, None), (2, "", None), (None, "No Id", "a"), (3, "Twice", "a"), (3, "Twice", "a"), (3, "Other", "a")]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 20, "b": 1, "Z": 17, "ä": 16, "": 3}, {f"s{k}": 1 + k % 3 for k in range(40)} | {"hot": 300}])
def test_manifest_against_definition(spark, sizes):
    rows = manifest_rows(sizes)
    assert sorted(map(tuple, merkle.audit(frame(spark, rows)).collect()), key=repr) == audited(rows)


def test_manifest_of_one_source_and_of_none(spark):
    rows = [(k, "t", "a") for k in range(5)]
    assert sorted(map(tuple, merkle.audit(frame(spark, rows)).collect()), key=repr) == audited(rows)
    assert sorted(map(tuple, merkle.audit(frame(spark, rows[:1])).collect()), key=repr) == audited(rows[:1])
    assert merkle.audit(frame(spark, rows).limit(0)).collect() == []


def test_proofs_of_some_leaves(spark):
    rows = manifest_rows({"a": 50, "b": 300})
    manifest = merkle.build(frame(spark, rows))
    some = merkle.with_paths(manifest, manifest.leaves.filter("doc_id % 17 = 0"))
    folded = some.select("doc_id", merkle.folded(F.col("path"), F.col("leaf")).alias("root")).collect()
    assert len(folded) == sum(1 for d, _, _ in rows if d is not None and d % 17 == 0) and {r.root for r in folded} == {manifest.root}
    store = {r.node: r.children for r in manifest.store().collect()}
    assert all(sha("".join(children)) == node for node, children in store.items()) and manifest.root in store
