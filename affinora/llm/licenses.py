"""License scan with ordered signature rules: regexes behind a keyword prefilter, priority and interval containment.

All of it is DataFrame functions. A text is lower-cased (A-Z) and cut into words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`; only documents with a
keyword are put into normal form (one space between words) and only the rules of the keywords found run over it. A rule's matches become word
intervals. Of these an interval goes that lies inside one of a rule with a higher place in the list: the list is ordered from full
notices to references, bare names and generic mentions, and longer names stand before those they contain.

The base phrases (`BASE`) are counted at every place where their words stand consecutively, whatever the rules say; their labels always stay.

Defined results: a null, empty or wordless text has no words, places or labels and scores 0. Rows that repeat count as they stand.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_OPEN, _SHUT = "\x01", "\x02"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Label, keyword of the prefilter, regex of the name in normal form. Longer names stand before those they contain.
NAMES = (
    ("agpl-3", "affero", r"(?:gnu )?affero general public licen[sc]e(?: version| v)? ?3(?: 0)?"),
    ("agpl-3", "agpl", r"agpl(?: v| version)? ?3(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e"),
    ("agpl", "agpl", r"agpl"),
    ("lgpl-3", "lesser general", r"(?:gnu )?lesser general public licen[sc]e(?: version| v)? ?3(?: 0)?"),
    ("lgpl-3", "lgpl", r"lgpl(?: v| version)? ?3(?: 0)?"),
    ("lgpl-2.1", "lesser general", r"(?:gnu )?lesser general public licen[sc]e(?: version| v)? ?2 1"),
    ("lgpl-2.1", "lgpl", r"lgpl(?: v| version)? ?2 1"),
    ("lgpl-2", "library general", r"(?:gnu )?library general public licen[sc]e(?: version| v)?(?: ?2(?: 0)?)?"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public licen[sc]e"),
    ("lgpl", "lgpl", r"lgpl"),
    ("gpl-3", "general public", r"(?:gnu )?general public licen[sc]e(?: version| v)? ?3(?: 0)?"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl(?: v| version)? ?3(?: 0)?"),
    ("gpl-2", "general public", r"(?:gnu )?general public licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl(?: v| version)? ?2(?: 0)?"),
    ("gpl-1", "general public", r"(?:gnu )?general public licen[sc]e(?: version| v)? ?1(?: 0)?"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e(?: version| v)?(?: ?1(?: [123])?)?"),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("apache-2", "apache", r"apache(?: software)? licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("apache-2", "apache", r"apache(?: v| version)? ?2(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[sc]e(?: version| v)? ?1 1"),
    ("apache-1", "apache", r"apache(?: software)? licen[sc]e(?: version| v)? ?1(?: 0)?"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e"),
    ("bsd-4-clause", "bsd", r"(?:(?:4|four) clause|original) bsd(?: licen[sc]e)?|bsd 4 clause(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(?:(?:3|three) clause|modified|new|revised) bsd(?: licen[sc]e)?|bsd 3 clause(?: licen[sc]e)?"),
    ("bsd-2-clause", "bsd", r"(?:(?:2|two) clause|simplified|freebsd) bsd(?: licen[sc]e)?|bsd 2 clause(?: licen[sc]e)?"),
    ("0bsd", "bsd", r"(?:zero|0) clause bsd(?: licen[sc]e)?|0bsd"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e"),
    ("mit-0", "mit", r"mit (?:0|no attribution) licen[sc]e"),
    ("mit", "mit licen", r"mit licen[sc]e"),
    ("mit", "expat", r"expat licen[sc]e"),
    ("x11", "x11", r"x11 licen[sc]e"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("mpl-2", "mpl", r"mpl(?: v| version)? ?2(?: 0)?"),
    ("mpl-1.1", "mpl", r"mpl(?: v| version)? ?1 1"),
    ("mpl-2", "mozilla", r"mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e(?: version| v)? ?1 1"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("epl-2", "eclipse", r"eclipse public licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public licen[sc]e(?: version| v)?(?: ?1(?: 0)?)?"),
    ("cddl", "common development", r"common development and distribution licen[sc]e(?: version| v)?(?: ?1(?: [01])?)?"),
    ("cpl-1", "common public", r"common public licen[sc]e(?: version| v)?(?: ?1(?: 0)?)?"),
    ("eupl", "european union", r"european union public licen[sc]e(?: version| v)?(?: ?1(?: [12])?)?"),
    ("bsl-1", "boost", r"boost software licen[sc]e(?: version| v)?(?: ?1(?: 0)?)?"),
    ("artistic-2", "artistic", r"artistic licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("artistic", "artistic", r"artistic licen[sc]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("psf-2", "python software", r"python software foundation licen[sc]e(?: version| v)?(?: ?2(?: 0)?)?"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[sc]e(?: version| v)?(?: ?1 1)?"),
    ("ms-pl", "microsoft public", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[sc]e"),
    ("odbl", "open database", r"open database licen[sc]e(?: version| v)?(?: ?1(?: 0)?)?"),
    ("openrail", "openrail", r"(?:bigscience )?openrail(?: m)?(?: licen[sc]e)?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "commons", r"creative commons zero(?: v?1 0)?(?: universal)?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1234] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1234] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1234] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1234] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1234] [05])?"),
    ("cc-by-nc-sa", "commons", r"creative commons attribution non ?commercial share ?alike(?: [1234] [05])?"),
    ("cc-by-nc-nd", "commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial(?: [1234] [05])?"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike(?: [1234] [05])?"),
    ("cc-by-nd", "commons", r"creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?"),
    ("cc-by", "commons", r"creative commons attribution(?: [1234] [05])?"),
    ("cc", "commons", r"creative commons licen[sc]e"),
)
# What stands around a name, from full notice to bare name, with the relevance of a match; {} is the name.
FRAMES = (
    (r"(?:this|the) (?:work|software|program|file|document|project|library|code|text|content)s? (?:is|are) (?:free software )?(?:licensed|released|distributed|available|provided|published)"
     r"(?: to you)? under (?:the )?(?:terms of )?(?:the )?{}", 1.0),
    (r"(?:licensed|released|distributed|available|published|redistributed?)(?: to you)? under (?:the )?(?:terms of )?(?:the )?{}", 0.95),
    (r"(?:see|subject to|governed by|terms of|copy of|permitted by|according to) (?:the )?(?:terms of )?(?:the )?{}", 0.9),
    (r"(?:spdx licen[sc]e identifier|licen[sc]e(?: type| name)?) {}", 0.9),
    (r"{} (?:for (?:more )?details|as published by|applies)", 0.85),
    (r"under (?:the )?{}", 0.8),
    (r"{}", 0.6),
)
# Short identifiers in normal form, too short or too common to stand for a license without a frame.
SHORT = (
    ("mit", "mit"), ("mit-0", "mit 0"), ("isc", "isc"), ("x11", "x11"), ("zlib", "zlib"), ("0bsd", "0bsd"), ("bsd-2-clause", "bsd 2 clause"), ("bsd-3-clause", "bsd 3 clause"),
    ("apache-2", "apache 2 0"), ("mpl-2", "mpl 2 0"), ("mpl-1.1", "mpl 1 1"), ("epl-2", "epl 2 0"), ("epl-1", "epl 1 0"), ("eupl", "eupl 1 [12]"), ("cddl", "cddl 1 [01]"),
    ("bsl-1", "bsl 1 0"), ("artistic-2", "artistic 2 0"), ("psf-2", "psf 2 0"), ("ofl-1.1", "ofl 1 1"), ("ms-pl", "ms pl"), ("ms-rl", "ms rl"), ("odbl", "odbl 1 0"),
)
# Frames of short identifiers, with the relevance of a match.
SHORT_FRAMES = (
    (r"spdx licen[sc]e identifier {}", 1.0),
    (r"(?:licen[sc]e(?: type| name| id)?|licensed under(?: the)?(?: terms of)?(?: the)?) {}(?! licen[sc]e)", 0.9),
    (r"{} licensed", 0.9),
)
# Texts and mentions without one name: label, keyword, regex, relevance. They stand after all names.
TEXTS = (
    ("mit", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose", 1.0),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted", 1.0),
    ("gpl", "redistribute it and or modify", r"you can redistribute it and or modify it under the terms", 0.9),
    ("unlicense", "unencumbered software", r"this is free and unencumbered software released into the public domain", 1.0),
    ("public-domain", "public domain", r"(?:released|dedicated|placed|is) (?:in(?:to)?|to) the public domain", 0.9),
    ("public-domain", "public domain", r"public domain", 0.5),
    ("all-rights-reserved", "rights reserved", r"all rights reserved", 0.8),
    ("proprietary", "proprietary", r"proprietary and confidential", 0.8),
    ("unstated", "licensed under", r"licensed under (?:a|an|the) \w+ licen[sc]e", 0.4),
)


#: Parts of words of which a text that any rule or base phrase matches has one at least, whatever stands between its words.
GATE = ("licen", "gpl", "apache", "cc", "bsd", "commons", "domain", "rights", "wtfpl", "openrail", "permission", "redistribut", "proprietary", "unencumbered")


def rules() -> list[tuple[int, str, str, str, float]]:
    """(priority, label, keyword, regex, relevance), in order: frames from the fullest to the bare name, names in their order, then short identifiers and texts."""
    out = []
    for frame, relevance in FRAMES:
        for label, keyword, name in NAMES:
            out.append((len(out), label, keyword, frame.replace("{}", f"(?:{name})"), relevance))
    for frame, relevance in SHORT_FRAMES:
        for label, name in SHORT:
            out.append((len(out), label, "licen", frame.replace("{}", f"(?:{name})"), relevance))
    for label, keyword, text, relevance in TEXTS:
        out.append((len(out), label, keyword, text, relevance))
    return out


def keywords() -> list[str]:
    return sorted({r[2] for r in rules()})


def _lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _places(norm: Column, regex: Column) -> Column:
    """Word intervals (start, past) of all matches in a normal form that begins and ends with a space.

    Matches are set in marks, which no word holds, and the marked words are looked up by their place: linear in the text.
    """
    whole = F.concat(F.lit("(?<= )(?:"), regex, F.lit(")(?= )"))
    words = F.split(F.regexp_replace(norm, whole, F.lit(f"{_OPEN}$0{_SHUT}")), " ", -1)
    at = lambda test: F.filter(F.transform(words, lambda w, i: F.when(test(w), i)), lambda i: i.isNotNull())
    # The split has an empty word before the first.
    starts, ends = at(lambda w: F.startswith(w, F.lit(_OPEN))), at(lambda w: F.endswith(w, F.lit(_SHUT)))
    found = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: F.struct((p["a"] - 1).alias("start"), p["b"].alias("past")))
    return F.when(F.rlike(norm, whole), found).otherwise(F.array().cast("array<struct<start:int,past:int>>"))


def _labelled(places: Column, label: str) -> Column:
    return F.transform(places, lambda p: F.struct(p["start"].alias("start"), F.lit(label).alias("label")))


def _kept(found: Column) -> Column:
    """(labels, score) of the intervals that lie in none of a rule before theirs.

    In the order of start, longest first, whatever can hold an interval stands before it; those that ended already are let go.
    """
    start = F.struct(F.array().cast("array<struct<past:int,priority:int>>").alias("open"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def add(acc, x):
        inside = F.exists(acc["open"], lambda o: (o["past"] >= -x["back"]) & (o["priority"] < x["priority"]))
        still = F.filter(acc["open"], lambda o: o["past"] > x["start"])
        return F.struct(
            F.array_append(still, F.struct((-x["back"]).alias("past"), x["priority"].alias("priority"))).alias("open"),
            F.when(inside, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(x["label"]))).alias("labels"),
            F.when(inside, acc["score"]).otherwise(F.greatest(acc["score"], x["relevance"])).alias("score"))

    return F.aggregate(F.array_sort(found), start, add, lambda acc: F.struct(acc["labels"], acc["score"]))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    lower = _lower(F.col("text"))
    gate = F.lit(False)
    for k in GATE:
        gate = gate | F.contains(F.col("lower"), F.lit(k))
    # "mpl" stands inside many words, so it counts at the start of one only.
    gate = gate | (F.contains(F.col("lower"), F.lit("mpl")) & F.rlike(F.col("lower"), F.lit(f"(?:^|{SEPARATORS})mpl")))
    norm = F.when(gate, F.concat(F.lit(" "), F.trim(F.regexp_replace("lower", SEPARATORS, " ")), F.lit(" ")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lower.alias("lower"))
    rows = rows.select("doc_id", F.regexp_count("lower", F.lit(WORD)).cast("long").alias("n_words"), norm.alias("norm"))
    present = F.filter(F.array(*map(F.lit, keywords())), lambda k: F.contains(F.col("norm"), k))
    rows = rows.withColumn("keys", F.when(F.col("norm").isNotNull(), present))
    all_rules = F.array(*[F.struct(F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(k).alias("keyword"), F.lit(x).alias("regex"), F.lit(v).alias("relevance"))
                          for p, label, k, x, v in rules()])
    mine = F.filter(all_rules, lambda r: F.array_contains(F.col("keys"), r["keyword"]))
    found = F.flatten(F.transform(mine, lambda r: F.transform(_places(F.col("norm"), r["regex"]), lambda p: F.struct(
        p["start"].alias("start"), (-p["past"]).alias("back"), r["priority"].alias("priority"), r["label"].alias("label"), r["relevance"].alias("relevance")))))
    base = F.flatten(F.array(*[_labelled(_places(F.col("norm"), F.lit(phrase)), label) for phrase, label in BASE.items()]))
    hit = F.col("norm").isNotNull()
    rows = rows.select("doc_id", "n_words", F.when(hit, base).alias("base"), F.when(hit & (F.size("keys") > 0), found).alias("found"))
    rows = rows.withColumn("kept", _kept(F.coalesce(F.col("found"), F.array().cast("array<struct<start:int,back:int,priority:int,label:string,relevance:double>>"))))
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    base_labels = F.coalesce(F.col("base.label"), F.array().cast("array<string>"))
    return rows.select(
        "doc_id", "n_words", F.when(F.col("base").isNotNull(), F.size("base")).otherwise(0).cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"), F.array_max("base.start").cast("long").alias("last_word"),
        labels(base_labels).alias("base_labels"), labels(F.concat(base_labels, F.col("kept.labels"))).alias("labels"),
        F.greatest(F.col("kept.score"), F.when(F.size(base_labels) > 0, 1.0).otherwise(0.0)).alias("score"))
