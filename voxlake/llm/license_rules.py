r"""Licence scan: ordered signature rules with a keyword prefilter and containment suppression (native).

A rule is ``(label, priority, keyword, regex)``. Texts are lower-cased (A-Z), cut into words
``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` and joined by single spaces; regexes run on that normal form, so
a span is an interval of word numbers. The rules are built from a table of licence families (names,
versions) and sentence templates, some hundreds in all, ordered by priority: whole notices, then
titles with versions, then bare titles, then SPDX tags, then weak hints.

Order of work, all in one pass over each text, with no join, shuffle or explode:

1. gate: texts without any trigger word skip everything but the word count;
2. keyword prefilter: a rule runs only if its keyword is among the text's words;
3. each surviving rule's matches become spans (first word, end word, priority, label);
4. a span is suppressed if a span of the same or a better priority contains it (ties: the earlier
   rule stays), found in one fold over the spans sorted by (start, longest first, priority, rule).

``base_labels`` are the three contract phrases, always kept: the method only adds labels.
``score`` is the weight of the best surviving priority, 0 without any span.

Defined cases: a null text counts as empty (0 words, empty labels, null positions, score 0);
repeated rows give repeated rows; very long texts cost one fold, linear in the spans per priority;
an empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import lower_az, sql_str

# Phrases and labels of the contract.
BASE_PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"     # words before lower-casing
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"               # between words after it

# Families: label stem, keyword that any of its notices contains, names, versions (as words).
FAMILIES = [
    ("mit", "mit", ["mit license", "mit licence", "x11 license", "expat license"], [""]),
    ("apache", "apache", ["apache license", "apache software license", "asf license"], ["", "1 0", "1 1", "2 0"]),
    ("gpl", "gpl", ["gnu gpl", "gpl"], ["", "1", "2", "3", "2 0", "3 0"]),
    ("gpl", "general", ["gnu general public license", "general public license"], ["", "1", "2", "3", "2 0", "3 0"]),
    ("lgpl", "lesser", ["gnu lesser general public license", "lesser general public license"], ["", "2 1", "3", "3 0"]),
    ("lgpl", "lgpl", ["gnu lgpl", "lgpl"], ["", "2 1", "3", "3 0"]),
    ("agpl", "affero", ["gnu affero general public license", "affero general public license"], ["", "1", "3", "3 0"]),
    ("bsd", "bsd", ["bsd license", "bsd licence", "bsd style license", "berkeley software distribution"],
     ["", "2 clause", "3 clause", "4 clause"]),
    ("mpl", "mozilla", ["mozilla public license"], ["", "1 0", "1 1", "2 0"]),
    ("epl", "eclipse", ["eclipse public license"], ["", "1 0", "2 0"]),
    ("cddl", "cddl", ["common development and distribution license", "cddl"], ["", "1 0", "1 1"]),
    ("cc-by", "cc", ["cc by"], ["", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "cc", ["cc by sa"], ["", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "cc", ["cc by nc"], ["", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "cc", ["cc by nd"], ["", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "cc", ["cc by nc sa"], ["", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-nd", "cc", ["cc by nc nd"], ["", "2 0", "2 5", "3 0", "4 0"]),
    ("cc0", "cc0", ["cc0", "creative commons zero"], ["", "1 0"]),
    ("cc-by", "commons", ["creative commons attribution"], ["", "2 0", "2 5", "3 0", "4 0"]),
    ("isc", "isc", ["isc license", "internet systems consortium license"], [""]),
    ("zlib", "zlib", ["zlib license", "zlib libpng license"], [""]),
    ("unlicense", "unlicense", ["the unlicense", "unlicense"], [""]),
    ("artistic", "artistic", ["artistic license", "perl artistic license"], ["", "1 0", "2 0"]),
    ("boost", "boost", ["boost software license"], ["", "1 0"]),
    ("ofl", "ofl", ["sil open font license", "sil ofl", "ofl"], ["", "1 0", "1 1"]),
]
# Sentence templates around "<name> [version]": priority (0 is best), regex before, regex after.
NOTICES = [
    (0, r"(?:this )?(?:work|program|software|file|library|code|document) is (?:free software )?(?:licensed|released|distributed|"
        r"made available) under (?:the )?(?:terms of (?:the )?)?", ""),
    (0, r"(?:licensed|released|distributed) under (?:the )?(?:terms of (?:the )?)?", ""),
    (1, r"(?:see|subject to|governed by|according to) (?:the )?(?:terms of (?:the )?)?", ""),
]
# Sentences without a family name: priority, keyword, regex, label.
PHRASES = [
    (0, "granted", r"permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    (0, "redistribution", r"redistribution and use in source and binary forms with or without modification", "bsd"),
    (0, "compliance", r"you may not use this file except in compliance with the license", "apache"),
    (0, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu", "gpl"),
    (1, "reserved", r"all rights reserved", "proprietary"),
    (1, "confidential", r"(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
    (1, "domain", r"(?:released into|dedicated to|in) the public domain", "public-domain"),
    (5, "license", r"(?:see|read) the (?:attached |accompanying )?license(?: file)?(?: for details)?", "unknown"),
    (5, "licensed", r"licensed under(?: the)?", "unknown"),
]
# SPDX identifiers as words: stem, identifier, versions. Without a version only the identifier sentence counts.
SPDX = [("mit", "mit", [""]), ("isc", "isc", [""]), ("zlib", "zlib", [""]), ("unlicense", "unlicense", [""]), ("apache", "apache", ["1 0", "1 1", "2 0"]),
        ("bsd", "bsd", ["2 clause", "3 clause", "4 clause"]), ("gpl", "gpl", ["1 0", "2 0", "3 0"]), ("lgpl", "lgpl", ["2 0", "2 1", "3 0"]),
        ("agpl", "agpl", ["1 0", "3 0"]), ("mpl", "mpl", ["1 0", "1 1", "2 0"]), ("epl", "epl", ["1 0", "2 0"]), ("cddl", "cddl", ["1 0", "1 1"]),
        ("artistic", "artistic", ["1 0", "2 0"]), ("boost", "bsl", ["1 0"]), ("ofl", "ofl", ["1 0", "1 1"]), ("cc0", "cc0", ["1 0"])]
# Short names that write the version with a v.
SHORT = ["gpl", "lgpl", "agpl", "mpl", "epl"]
#: Weight of each priority in ``score``.
WEIGHTS = [1.0, 0.95, 0.85, 0.8, 0.75, 0.3]
# Texts without one of these are not looked at further; each keyword above contains or implies one. Between words
# stands what the normal form makes one blank.
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TRIGGER = (r"(?i)licen|(?<![a-z0-9])(?:[al]?gpl|[al]?gplv[0-9]|[me]pl|[me]plv[0-9]|apache|bsd|bsl|artistic|cddl|cc0?|ofl|berkeley)(?![a-z0-9])|redistribut|confidential|"
           + "|".join(words.replace(" ", RAW_GAP) for words in ("hereby granted", "public domain", "rights reserved", "creative commons")))


def rules() -> list[tuple[int, str, str, str]]:
    """``(priority, keyword, regex, label)`` for every rule, best priority first."""
    found: dict[tuple[str, str], tuple[int, str, str, str]] = {}
    for stem, keyword, names, versions in FAMILIES:
        for name in names:
            key = next(w for w in name.split() if w == keyword) if keyword in name.split() else name.split()[0]
            for version in versions:
                title = name + (rf"(?: version| v)? (?:v )?{version}" if version else "")
                label = stem + ("-" + version.replace(" 0", "").replace(" ", ".") if version else "")
                for priority, before, after in NOTICES:
                    add = (priority, key, before + title + after, label)
                    found.setdefault(add[1:3], add)
                add = (2 if version else 3, key, title, label)
                found.setdefault(add[1:3], add)
    for stem, name, versions in SPDX:
        for version in versions:
            label, title = stem + ("-" + version.replace(" 0", "").replace(" ", ".") if version else ""), f"{name} {version}".strip()
            tail = "(?: only| or later)?"
            some = [(4, "spdx", f"spdx license identifier {title}{tail}")]
            if version:
                some.append((4, name, title + tail))
            if name == "bsd":
                some.append((2, name, f"{version} bsd(?: licen[cs]e)?"))
            if name in SHORT:
                v = version.replace(" 0", "(?: 0)?")
                some += [(2, f"{name}v{version[0]}", f"(?:gnu )?{name}v{v}"), (2, name, f"(?:gnu )?{name} v{v}")]
            for priority, key, regex in some:
                found.setdefault((key, regex), (priority, key, regex, label))
    for priority, key, regex, label in PHRASES:
        found.setdefault((key, regex), (priority, key, regex, label))
    return sorted(found.values(), key=lambda r: r[0])


def _rules_sql() -> str:
    items = ", ".join(f"named_struct('p', {p}, 'kw', {sql_str(kw)}, 're', {sql_str('(?<= )' + rx + '(?= )')}, 'label', {sql_str(lb)}, 'n', {n})"
                      for n, (p, kw, rx, lb) in enumerate(rules()))
    return f"array({items})"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans`` per row."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(key).alias("k"), t.alias("t"))
    d = d.select("k", F.regexp_count("t", F.lit(RAW_WORD)).cast("long").alias("n_words"),
                 F.when(F.col("t").rlike(TRIGGER), F.col("t")).alias("t"))
    # The normal form, only of texts that pass the gate: " word word ... ".
    d = d.withColumn("s", F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_az(F.col("t")), NOT_WORD, " ")), F.lit(" ")))
    base = []
    for phrase, label in BASE_PHRASES:
        n = len(phrase.split())
        d = d.withColumn(f"b_{label}", F.expr(f"split(s, '(?<= ){phrase}(?= )', -1)"))
        base.append((label, n))
    blanks = "length({0}) - length(replace({0}, ' ', ''))"       # words = blanks - 1 of " a b "; of a left piece: blanks - 1
    for label, n in base:
        last = f"element_at(b_{label}, -1)"
        d = d.withColumn(f"n_{label}", F.expr(f"cast(coalesce(size(b_{label}), 1) - 1 as bigint)"))
        d = d.withColumn(f"f_{label}", F.expr(f"if(n_{label} > 0, cast({blanks.format(f'b_{label}[0]')} - 1 as bigint), null)"))
        d = d.withColumn(f"l_{label}", F.expr(f"if(n_{label} > 0, cast(n_words - ({blanks.format(last)} - 1) - {n} as bigint), null)"))
    labels = sorted(label for label, _ in base)
    d = d.withColumn("base_list", F.expr(
        "filter(array(" + ", ".join(f"if(n_{x} > 0, '{x}', null)" for x in labels) + "), x -> x is not null)"))
    # Keyword prefilter, then the regexes of what passes.
    keywords = sorted({kw for _, kw, _, _ in rules()})
    d = d.withColumn("has", F.expr(
        "if(s is null, array(), filter(array(" + ", ".join(sql_str(k) for k in keywords) + "), w -> contains(s, concat(' ', w, ' '))))"))
    d = d.withColumn("todo", F.expr(f"if(size(has) = 0, slice({_rules_sql()}, 1, 0), filter({_rules_sql()}, r -> array_contains(has, r.kw)))"))
    d = d.withColumn("hits", F.expr("""filter(transform(todo, r -> named_struct(
        'p', r.p, 'n', r.n, 'label', r.label, 'm', regexp_extract_all(s, r.re, 0), 'gap', split(s, r.re, -1))), h -> size(h.m) > 0)"""))
    # Word numbers: the running length, in words, of gaps and matches (a gap ends in a blank).
    d = d.withColumn("spans", F.expr("""array_sort(flatten(transform(hits, h -> transform(aggregate(
        sequence(0, size(h.m) - 1),
        named_struct('at', 0, 'out', cast(array() as array<struct<a:int,b:int>>)),
        (acc, i) -> named_struct(
            'at', acc.at + (length(h.gap[i]) - length(replace(h.gap[i], ' ', ''))) + (length(h.m[i]) - length(replace(h.m[i], ' ', ''))),
            'out', array_append(acc.out, named_struct(
                'a', acc.at + length(h.gap[i]) - length(replace(h.gap[i], ' ', '')) - 1,
                'b', acc.at + length(h.gap[i]) - length(replace(h.gap[i], ' ', ''))
                     + length(h.m[i]) - length(replace(h.m[i], ' ', '')))))
        ).out, x -> named_struct('a', x.a, 'ob', -x.b, 'p', h.p, 'n', h.n, 'label', h.label)))))"""))
    levels = len(WEIGHTS)
    reach = ", ".join(f"'e{i}', -1" for i in range(levels))
    # Best end so far of any span at least as good; sorted by start, a span within it is contained.
    seen = "greatest(" + ", ".join(f"if({i} <= s2.p, acc.e{i}, -1)" for i in range(levels)) + ", -1)"
    step = ", ".join(f"'e{i}', if(s2.p = {i}, greatest(acc.e{i}, -s2.ob), acc.e{i})" for i in range(levels))
    d = d.withColumn("kept", F.expr(f"""aggregate(spans,
        named_struct({reach}, 'best', {levels}, 'labels', cast(array() as array<string>)),
        (acc, s2) -> named_struct({step},
            'best', if({seen} >= -s2.ob, acc.best, least(acc.best, s2.p)),
            'labels', if({seen} >= -s2.ob, acc.labels, array_union(acc.labels, array(s2.label)))))"""))
    weight = "CASE kept.best " + " ".join(f"WHEN {i} THEN {w}D" for i, w in enumerate(WEIGHTS)) + " ELSE 0D END"
    return d.select(
        F.col("k").alias(key), "n_words",
        F.expr(" + ".join(f"n_{x}" for x in labels)).alias("n_base"),
        F.expr("least(" + ", ".join(f"f_{x}" for x in labels) + ")").alias("first_word"),
        F.expr("greatest(" + ", ".join(f"l_{x}" for x in labels) + ")").alias("last_word"),
        F.expr("array_join(base_list, ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_union(base_list, coalesce(kept.labels, array()))), ',')").alias("labels"),
        F.expr(f"greatest(if(size(base_list) > 0, {WEIGHTS[3]}D, 0D), coalesce({weight}, 0D))").alias("score"),
        F.expr("coalesce(size(spans), 0)").cast("long").alias("n_spans"))
