r"""License scans by ordered signature rules, in column expressions only.

Texts are first held against a few substrings; those with none have no detections, and the others
are rewritten to single-spaced lower-case words, on which the rules are regular expressions.
Each rule has keywords one of which must begin a word of the text before its expression is tried. Rules are ordered by level
(license text, tag, notice, reference, mention) and inside a level by their place. A detection is an
interval of words; one that lies inside a detection of a better level, or inside a longer one (or
the same, of an earlier rule) of its own level, is suppressed. So the many readings of one notice
leave the one that explains most of it.

Everything happens inside a row, so nothing is shuffled and a repeated license line costs only its
own document. Null and empty texts have no words and no detections, very long ones are read whole.
Detections that tie (the same words, the same level) leave the one of the earlier rule. Repeated rows
are scanned each, an empty table gives no rows. Extra columns pass through whatever their names;
columns named as the three results are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.llm.common import free_names, read

#: The phrases whose places are counted, with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Characters that stand between words, in lower-cased text.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: Whatever a rule matches holds one of these, passes GATE_UNDER or GATE_SHORT, or has "cc" before
#: "by" and the like; other texts need no rules.
GATES = ("licen", "gpl", "spdx", "creative", "domain", "granted", "redistribut", "wtfpl", "copyleft", "conditions are met", "apache", "bsd", "cddl", "eupl", "gfdl", "odbl", "commons", "portions", "endorse", "advertising", "liable", "waived", "prohibited")
GATE_UNDER = r"(?i)(?:released|distributed|available|provided|published|covered|offered|shared)[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+under"
GATE_SHORT = r"(?i)(?<![0-9a-z])(?:[em]pl|(?:odc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by|ms[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[pr]l))(?![0-9a-z])"
GATE_CC = r"(?i)cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+(?:by|0|zero|sa|nc|nd)|cc0"

L = "licen[sc]e"
V = "(?:version |v ?)?"
#: label, SPDX id in words, expression of the name, keywords (one has to begin a word), whether the name
#: alone is telling.
NAMES = (
    ("mit", "mit", "mit(?: expat)?", "mit", False),
    ("mit-0", "mit 0", "mit(?: no attribution| 0)", "mit", False),
    ("x11", "x11", "x11", "x11", False),
    ("isc", "isc", "isc", "isc", False),
    ("0bsd", "0bsd", "(?:0bsd|zero clause bsd|bsd zero clause)", "0bsd|bsd", True),
    ("bsd-2-clause", "bsd 2 clause", "(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", "bsd|freebsd", False),
    ("bsd-3-clause", "bsd 3 clause", "(?:bsd 3 clause|3 clause bsd|three clause bsd|(?:new|revised|modified) bsd)", "bsd", False),
    ("bsd-4-clause", "bsd 4 clause", "(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)", "bsd", False),
    ("bsd", "bsd", "(?:bsd|bsd style|berkeley software distribution)", "bsd|berkeley", False),
    ("apache-1.1", "apache 1 1", f"apache(?: software)?(?: {L})? {V}1 1", "apache", True),
    ("apache-2", "apache 2 0", f"apache(?: software)?(?: {L})? {V}2(?: 0)?", "apache", True),
    ("apache", "apache", "apache(?: software)?", "apache", False),
    ("gpl-1", "gpl 1 0", f"(?:gnu )?(?:general public {L}|gpl) ?{V}1(?: 0)?", "gpl|general public", True),
    ("gpl-2-or-later", "gpl 2 0 or later", f"(?:gnu )?(?:general public {L}|gpl) ?{V}2(?: 0)? (?:or (?:at your option )?)?(?:any )?later(?: version)?", "gpl|general public", True),
    ("gpl-2", "gpl 2 0(?: only)?", f"(?:gnu )?(?:general public {L}|gpl) ?{V}2(?: 0)?(?: only)?", "gpl|general public", True),
    ("gpl-3-or-later", "gpl 3 0 or later", f"(?:gnu )?(?:general public {L}|gpl) ?{V}3(?: 0)? (?:or (?:at your option )?)?(?:any )?later(?: version)?", "gpl|general public", True),
    ("gpl-3", "gpl 3 0(?: only)?", f"(?:gnu )?(?:general public {L}|gpl) ?{V}3(?: 0)?(?: only)?", "gpl|general public", True),
    ("gpl", "gpl", f"(?:gnu (?:general public {L}|gpl)|general public {L}|gpl)", "gpl|general public", True),
    ("lgpl-2", "lgpl 2 0(?: only| or later)?", f"(?:gnu )?(?:library general public {L}|lgpl) ?{V}2(?: 0)?", "lgpl|lesser|library", True),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", f"(?:gnu )?(?:lesser general public {L}|lgpl) ?{V}2 1", "lgpl|lesser|library", True),
    ("lgpl-3", "lgpl 3 0(?: only| or later)?", f"(?:gnu )?(?:lesser general public {L}|lgpl) ?{V}3(?: 0)?", "lgpl|lesser|library", True),
    ("lgpl", "lgpl", f"(?:gnu )?(?:(?:lesser|library) general public {L}|lgpl)", "lgpl|lesser|library", True),
    ("agpl-3", "agpl 3 0(?: only| or later)?", f"(?:gnu )?(?:affero general public {L}|agpl) ?{V}3(?: 0)?", "agpl|affero", True),
    ("agpl", "agpl", f"(?:gnu )?(?:affero general public {L}|agpl)", "agpl|affero", True),
    ("gfdl", "gfdl 1 [123](?: only| or later)?", f"(?:gnu )?(?:free documentation {L}|gfdl)(?: {V}1 [123])?", "gfdl|free documentation", True),
    ("mpl-1.1", "mpl 1 1", f"(?:mozilla public {L}|mpl) {V}1 1", "mpl|mozilla", True),
    ("mpl-2", "mpl 2 0", f"(?:mozilla public {L}|mpl) {V}2(?: 0)?", "mpl|mozilla", True),
    ("mpl", "mpl", f"mozilla public {L}", "mozilla", True),
    ("epl-1", "epl 1 0", f"(?:eclipse public {L}|epl) {V}1(?: 0)?", "epl|eclipse", True),
    ("epl-2", "epl 2 0", f"(?:eclipse public {L}|epl) {V}2(?: 0)?", "epl|eclipse", True),
    ("epl", "epl", f"eclipse public {L}", "eclipse", True),
    ("cddl-1", "cddl 1 0", f"(?:common development and distribution {L}|cddl)(?: {V}1(?: 0)?)?", "cddl|common development", True),
    ("cpl-1", "cpl 1 0", f"common public {L}(?: {V}1(?: 0)?)?", "common public", True),
    ("eupl", "eupl 1 [12]", f"(?:european union public {L}|eupl)(?: {V}1 [12])?", "eupl|european union", True),
    ("artistic-1", "artistic 1 0", f"artistic {L} {V}1(?: 0)?", "artistic", True),
    ("artistic-2", "artistic 2 0", f"artistic {L} {V}2(?: 0)?", "artistic", True),
    ("artistic", "artistic", "artistic", "artistic", False),
    ("bsl-1", "bsl 1 0", f"boost software {L}(?: {V}1(?: 0)?)?", "boost", True),
    ("zlib", "zlib", "(?:zlib|zlib libpng)", "zlib", False),
    ("libpng", "libpng", "libpng", "libpng", False),
    ("openssl", "openssl", "openssl", "openssl", False),
    ("python-2", "python 2 0", f"(?:python software foundation|psf|python) {L} {V}2(?: 0)?", "psf|python", True),
    ("psf", "psf 2 0", "(?:python software foundation|psf)", "psf|python", False),
    ("php-3", "php 3 0(?:1)?", f"php {L} {V}3 0?1?", "php", True),
    ("ruby", "ruby", "ruby", "ruby", False),
    ("postgresql", "postgresql", "postgresql", "postgresql", False),
    ("ncsa", "ncsa", "(?:ncsa|university of illinois(?: ncsa)?)(?: open source)?", "ncsa|illinois", False),
    ("ofl-1.1", "ofl 1 1", f"(?:sil )?open font {L}(?: {V}1 [01])?", "font", True),
    ("wtfpl", "wtfpl", f"(?:wtfpl|do what the fuck you want to public {L})", "wtfpl|what the", True),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", True),
    ("ms-pl", "ms pl", f"(?:microsoft public {L}|ms pl)", "microsoft|ms", True),
    ("ms-rl", "ms rl", f"(?:microsoft reciprocal {L}|ms rl)", "microsoft|ms", True),
    ("odbl", "odbl 1 0", f"(?:open (?:data commons open )?database {L}|odbl)", "odbl|database", True),
    ("odc-by", "odc by 1 0", "(?:open data commons attribution|odc by)", "odc|open data", True),
    ("cc0", "cc0 1 0", "(?:cc0|cc zero|creative commons zero)(?: 1 0)?", "cc|creative commons", True),
    ("cc-by-nc-nd", "cc by nc nd [1234] [05]", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?)(?: [1234] [05])?", "cc|creative commons", True),
    ("cc-by-nc-sa", "cc by nc sa [1234] [05]", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1234] [05])?", "cc|creative commons", True),
    ("cc-by-nc", "cc by nc [1234] [05]", "(?:cc by nc|creative commons attribution non ?commercial)(?: [1234] [05])?", "cc|creative commons", True),
    ("cc-by-nd", "cc by nd [1234] [05]", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?(?: works)?)(?: [1234] [05])?", "cc|creative commons", True),
    ("cc-by-sa", "cc by sa [1234] [05]", "(?:cc by sa|creative commons attribution share ?alike)(?: [1234] [05])?", "cc|creative commons", True),
    ("cc-by", "cc by [1234] [05]", "(?:cc by|creative commons attribution)(?: [1234] [05])?", "cc|creative commons", True),
)
#: Contexts in which a name stands: level, score, keyword (else the name's), expression around it.
CONTEXTS = (
    (2, 0.98, "spdx", "spdx {L} identifier {id}"),
    (3, 0.9, "", "(?:licensed|released|distributed|available|provided|published|covered|offered|shared|dual licensed) under (?:an? |the )?(?:terms (?:and conditions )?of (?:the )?)?{name}(?: {L})?(?: agreement)?"),
    (4, 0.8, "", "(?:under|subject to|governed by|terms of|according to) (?:an? |the )?(?:terms (?:and conditions )?of (?:the )?)?{name} {L}"),
    (5, 0.6, "", "{mention}"),
)
#: Sentences of license texts: label, words, keyword (one that the sentence itself holds).
TEXTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "granted"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial portions"),
    ("isc", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", "granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribut"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistribut"),
    ("bsd-3-clause", "neither the name of (?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse or promote products", "endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising"),
    ("apache-2", "you may not use this file except in compliance with the license", "license"),
    ("apache-2", "you may obtain a copy of the license at http www apache org licenses license 2 0", "license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "license"),
    ("gpl-2-or-later", "either version 2 of the license or at your option any later version", "license"),
    ("gpl-3-or-later", "either version 3 of the license or at your option any later version", "license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "license"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "license"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "license"),
    ("epl-1", "this program and the accompanying materials are made available under the terms of the eclipse public license", "license"),
    ("bsl-1", "distributed under the boost software license version 1 0", "license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "liable"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "domain"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed", "license"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", "license"),
    ("public-domain", "(?:dedicated|released|placed|is|are) (?:in|into|to) the public domain", "domain"),
    ("cc0", "to the extent possible under law (?:[^ ]+ ){1,8}has waived all copyright and related or neighboring rights", "waived"),
    ("cc-by", "this work is licensed under a creative commons attribution [1234] [05] international license", "creative"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike [1234] [05] international license", "creative"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial [1234] [05] international license", "creative"),
    ("proprietary", "(?:unauthorized|unauthorised) (?:copying|use|reproduction|redistribution)(?: or (?:copying|use|reproduction|redistribution))? (?:[^ ]+ ){0,6}is (?:strictly )?prohibited", "prohibited"),
)


def rules() -> list[tuple[int, str, str, float, str]]:
    """All rules in order: level, label, keyword, score, expression (of words, each led by a blank)."""
    out = [(1, label, word, 1.0, f" {text}(?= )") for label, text, word in TEXTS]
    for level, score, word, shape in CONTEXTS:
        for label, spdx, name, own_word, alone in NAMES:
            text = shape.format(L="licen[sc]e", id=spdx, name=name, mention=name if alone else f"{name} licen[sc]e")
            out.append((level, label, word or own_word, score, f" {text}(?= )"))
    return out


def spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def intervals(canon: Column, pattern: Column) -> Column:
    """Word intervals (start, end) of all matches: gaps between them, counted in words, add up."""
    found = F.regexp_extract_all(canon, pattern, F.lit(0))
    gaps = F.transform(F.slice(F.split(canon, pattern, -1), 1, F.size(found)), spaces)
    steps = F.arrays_zip(gaps.alias("gap"), F.transform(found, spaces).alias("width"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        at = acc["at"] + s["gap"]
        return F.struct((at + s["width"]).alias("at"), F.concat(acc["out"], F.array(F.struct(at.alias("start"), (at + s["width"]).alias("end")))).alias("out"))

    return F.aggregate(steps, start, add)["out"]


def detections(canon: Column) -> Column:
    """All matches of all rules whose keyword occurs at the start of a word, in the order that
    suppression needs: a detection that can contain another one comes before it."""
    table = F.array(*[F.struct(F.lit(level).alias("level"), F.lit(i).alias("rule"), F.lit(label).alias("label"), F.array(*[F.lit(f" {w}") for w in word.split("|")]).alias("words"), F.lit(score).alias("score"), F.lit(text).alias("text")) for i, (level, label, word, score, text) in enumerate(rules())])
    tried = F.filter(table, lambda r: F.exists(r["words"], lambda w: F.contains(canon, w)))
    found = F.flatten(F.transform(tried, lambda r: F.transform(intervals(canon, r["text"]), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), r["level"].alias("level"), r["rule"].alias("rule"), r["label"].alias("label"), r["score"].alias("score")))))
    return F.array_sort(found)


LEVELS = (1, 2, 3, 4, 5)


def surviving(found: Column) -> Column:
    """Suppression by containment, in one pass: for each level the farthest end so far."""
    empty = F.struct(*[F.lit(-1).alias(f"m{k}") for k in LEVELS], F.array().cast("array<struct<start:int,end:int,label:string,score:double>>").alias("out"))

    def add(acc: Column, d: Column) -> Column:
        end = -d["back"]
        held = F.lit(False)
        for k in LEVELS:
            held = held | ((d["level"] >= k) & (acc[f"m{k}"] >= end))
        ends = [F.when(d["level"] == k, F.greatest(acc[f"m{k}"], end)).otherwise(acc[f"m{k}"]).alias(f"m{k}") for k in LEVELS]
        one = F.array(F.struct(d["start"].alias("start"), end.alias("end"), d["label"].alias("label"), d["score"].alias("score")))
        return F.struct(*ends, F.when(held, acc["out"]).otherwise(F.concat(acc["out"], one)).alias("out"))

    return F.aggregate(found, empty, add)["out"]


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (its columns first) with ``n_words``, ``base`` (an array of word starts
    for each base phrase) and ``licenses`` (the surviving detections: start, end, label, score)."""
    names = [c for c in docs.columns if c.lower() not in ("n_words", "base", "licenses")]
    canon_, found_ = free_names(docs, "canon", "found")
    low = F.lower(F.col(text))
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains(low, F.lit(word))
    gate = gate | (F.contains(low, F.lit("under")) & F.col(text).rlike(GATE_UNDER))
    short = F.contains(low, F.lit("mpl")) | F.contains(low, F.lit("epl")) | F.contains(low, F.lit("odc")) | F.contains(low, F.lit("ms"))
    gate = gate | (short & F.col(text).rlike(GATE_SHORT))
    gate = gate | (F.contains(low, F.lit("cc")) & F.col(text).rlike(GATE_CC))
    words = F.coalesce(F.size(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))), F.lit(0))
    lowered = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    canon = F.when(gate, F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, BETWEEN, " ")), F.lit(" ")))
    step = docs.select(*names, words.cast("long").alias("n_words"), canon.alias(canon_))
    starts = [F.transform(intervals(F.col(canon_), F.lit(f" {phrase}(?= )")), lambda s: s["start"].cast("long")) for phrase, _ in BASE]
    none = F.array().cast("array<array<bigint>>")
    step = step.select(*names, "n_words", F.when(F.col(canon_).isNotNull(), F.array(*starts)).otherwise(none).alias("base"), F.when(F.col(canon_).isNotNull(), detections(F.col(canon_))).alias(found_))
    empty = F.array().cast("array<struct<start:int,end:int,label:string,score:double>>")
    return step.select(*names, "n_words", "base", F.coalesce(surviving(F.col(found_)), empty).alias("licenses"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.flatten("base")
    by_phrase = [F.when(F.size(F.coalesce(F.get("base", F.lit(i)), F.array())) > 0, F.lit(label)) for i, (_, label) in enumerate(BASE)]
    base = F.array_sort(F.array_compact(F.array(*by_phrase)))
    step = found.select("doc_id", "n_words", places.alias("places"), base.alias("b"), "licenses")
    labels = F.array_sort(F.array_distinct(F.concat("b", F.col("licenses.label"))))
    score = F.greatest(F.coalesce(F.array_max("licenses.score"), F.lit(0.0)), F.when(F.size("b") > 0, 0.9).otherwise(0.0))
    return step.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("b", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )
