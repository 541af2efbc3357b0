"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

Blocks are the lines, and the windows of consecutive words over the whole text, whatever its line breaks:
one starts at every word that occurs in a template, and a template sees as many of its words as the template
has itself and may be missing. A block meets a template if it holds at least ``CONTAINMENT`` of the
template's distinct words, those among them that tell it from other licenses. Words that occur in a template are ordered by their global frequency, rarest
first. With ``o`` the words needed, a matching block must share one of its first ``m - o + 1`` words with the
template's first ``t - o + 1`` words (prefix filter), have ``m >= o`` words (length filter), and have
enough words left after the shared one on both sides (positional filter). Pairs that pass, each
emitted at its first shared word only, are confirmed by their full overlap and the required words.

Templates are a parameter; their words and prefixes are small by that and are sent along as literals
and a broadcast table. Texts are read once; blocks are made only of texts that hold enough words of a template,
and only windows with a word of some template's prefix are kept.

Defined results: null, empty and wordless texts have no words, no labels and score 0; a text without
license has empty label strings; repeated rows get equal rows; an empty table gives an empty table;
extra columns are not read.
"""

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import lower_ascii, stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Opening words of public license notices.
TEMPLATES = {
    "agpl-notice": "licensed under the GNU Affero General Public License",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-text": "you may not use this file except in compliance with the License",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-notice": "licensed under a Creative Commons Attribution International License",
    "cc-by-nc-notice": "Licensed under CC BY-NC",
    "gpl-notice": "licensed under the GNU General Public License, version 3",
    "gpl-text": "redistribute it and/or modify it under the terms of the GNU General Public License",
    "mit-notice": "released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mpl-2.0-notice": "subject to the terms of the Mozilla Public License",
}
CONTAINMENT = 0.8

#: The words that tell a notice from those of other licenses; a match holds all of them.
REQUIRED = {
    "agpl-notice": "affero",
    "apache-2.0-notice": "apache",
    "apache-2.0-text": "compliance",
    "bsd-text": "redistribution",
    "cc-by-notice": "creative commons",
    "cc-by-nc-notice": "cc nc",
    "gpl-notice": "gnu general",
    "gpl-text": "gnu general",
    "mit-notice": "mit",
    "mit-text": "permission",
    "mpl-2.0-notice": "mozilla",
}


def _words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def _needed(size: int, containment: float) -> int:
    return max(1, math.ceil(round(size * containment, 9)))


def _places(phrase: str) -> str:
    """SQL: positions in ``flat`` at which the phrase's words stand consecutively."""
    parts = phrase.split(" ")
    same = " and ".join(f"flat[i + {j}] = '{p}'" for j, p in enumerate(parts))
    return (
        f"if(size(flat) >= {len(parts)}, filter(sequence(0, greatest(size(flat) - {len(parts)}, 0)), i -> {same}),"
        " cast(array() as array<int>))"
    )


def _literals(words: list[str]):
    return F.array(*[F.lit(w) for w in words])


def _parsed(docs: DataFrame, sets: dict[str, list[str]], needed: dict[str, int]) -> DataFrame:
    """Per row: word count, phrase places, and the template words of its lines and of the whole text.

    The latter two are null if the text holds too few words of every template.
    """
    vocabulary = _literals(sorted({w for words in sets.values() for w in words}))
    least = min(needed.values())
    words = docs.select(
        "doc_id",
        F.xxhash64("text").alias("version"),
        F.transform(
            F.split(lower_ascii("text"), "\n", -1), lambda line: F.regexp_extract_all(line, F.lit(WORD), F.lit(0))
        ).alias("lines"),
        F.contains(lower_ascii("text"), F.lit("license")).alias("named"),
    ).withColumn("flat", F.flatten("lines"))
    words = words.withColumn("held", F.array_intersect("flat", vocabulary))
    able = F.lit(False)
    for name, template in sets.items():
        able = able | (F.size(F.array_intersect("held", _literals(template))) >= needed[name])
    lines = F.filter(
        F.transform("lines", lambda w: F.array_intersect(w, vocabulary)), lambda tokens: F.size(tokens) >= least
    )
    places = F.filter(
        F.transform("flat", lambda w, i: F.struct(i.alias("at"), w.alias("token"))),
        lambda x: F.array_contains("held", x["token"]),
    )
    found = words.withColumn("able", able).select(
        "doc_id",
        "version",
        F.size("flat").cast("long").alias("n_words"),
        F.when(F.col("able"), lines).alias("line_tokens"),
        F.when(F.col("able"), places).alias("places"),
        F.when(F.col("named"), F.col("flat")).otherwise(F.expr("cast(array() as array<string>)")).alias("flat"),
    )
    for i, phrase in enumerate(PHRASES):
        found = found.withColumn(f"at{i}", F.expr(_places(phrase)))
    return found.drop("flat")


def _blocks(parsed: DataFrame, rare: list[str], least: int, longest: int) -> DataFrame:
    """One row per block with its template words and their distances from its start (0 in a line)."""
    able = parsed.where(F.col("places").isNotNull())
    line = able.select("doc_id", "version", F.explode("line_tokens").alias("tokens")).withColumn(
        "block", F.transform("tokens", lambda t: F.struct(F.lit(0).alias("off"), t.alias("token")))
    )
    windows = F.transform(
        "places",
        lambda x, k: F.transform(
            F.filter(F.slice("places", k + 1, longest), lambda y: y["at"] < x["at"] + longest),
            lambda y: F.struct((y["at"] - x["at"]).alias("off"), y["token"].alias("token")),
        ),
    )
    kept = F.filter(windows, lambda w: (F.size(w) >= least) & F.arrays_overlap(w["token"], _literals(rare)))
    window = able.select("doc_id", "version", F.explode(kept).alias("block")).withColumn(
        "tokens", F.array_distinct(F.col("block")["token"])
    )
    return line.unionByName(window.where(F.size("tokens") >= least))


def licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    containment: float = CONTAINMENT,
    required: dict[str, str] | None = None,
) -> DataFrame:
    """Per row: ``doc_id``, words, phrase places, labels, and the best containment of a template."""
    spark = docs.sparkSession
    required = required if required is not None else {} if templates else REQUIRED
    lists = {name: _words(text) for name, text in (templates or TEMPLATES).items()}
    sets = {name: list(dict.fromkeys(words)) for name, words in lists.items()}
    needed = {name: _needed(len(words), containment) for name, words in sets.items()}
    reach = {name: len(words) + len(sets[name]) - needed[name] for name, words in lists.items()}
    vocabulary = sorted({w for words in sets.values() for w in words})
    least = min(needed.values())
    parsed = stage(_parsed(docs, sets, needed), "license-blocks")
    # global frequency order of the template words: at most one row per word
    counts = {r["token"]: r["n"] for r in parsed.select(F.explode("places.token").alias("token")).groupBy("token").agg(
        F.count("*").alias("n")
    ).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for name, words in sets.items():
        ranked, o = sorted(words, key=rank.__getitem__), needed[name]
        prefix = ranked[: len(words) - o + 1]
        own = _words(required.get(name, ""))
        index += [(w, i, name, len(words), o, reach[name], ranked, own) for i, w in enumerate(prefix)]
    prefixes = spark.createDataFrame(
        index, "token string, at_t int, template string, t int, o int, reach int, words array<string>, own array<string>"
    )
    blocks = _blocks(parsed, sorted({x[0] for x in index}), least, max(reach.values()))
    ordered = blocks.withColumn("tokens", F.array_intersect(_literals(order), "tokens")).withColumn(
        "m", F.size("tokens")
    )
    probes = ordered.select(
        "*", F.posexplode(F.slice("tokens", F.lit(1), F.col("m") - least + 1)).alias("at_b", "token")
    )
    pairs = probes.join(F.broadcast(prefixes), "token").where(
        (F.col("m") >= F.col("o"))
        & (F.col("at_b") <= F.col("m") - F.col("o"))
        & (F.least(F.col("m") - F.col("at_b"), F.col("t") - F.col("at_t")) >= F.col("o"))
        & (F.size(F.array_intersect(F.expr("slice(tokens, 1, at_b)"), "words")) == 0)
    )
    within = F.filter("block", lambda x: x["off"] < F.col("reach"))
    seen = F.transform(within, lambda x: x["token"])
    matches = pairs.withColumn("overlap", F.size(F.array_intersect("words", seen))).where(
        (F.col("overlap") >= F.col("o")) & (F.size(F.array_except("own", seen)) == 0)
    )
    best = matches.groupBy(F.col("doc_id").alias("_doc"), F.col("version").alias("_version")).agg(
        F.collect_set("template").alias("templates"), F.max(F.col("overlap") / F.col("t")).alias("best")
    )
    out = parsed.join(
        best, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version")), "left"
    )
    places = F.concat(*[f"at{i}" for i in range(len(PHRASES))])
    base = F.array_compact(
        F.array(*[F.when(F.size(f"at{i}") > 0, F.lit(v)) for i, v in enumerate(PHRASES.values())])
    )
    added = F.coalesce("templates", F.expr("cast(array() as array<string>)"))
    return out.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, added))), ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )
