"""License scan by a positional index of rare licence words.

Words are runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased. One pass over the texts
keeps where licence words stand and where key phrases begin. Every licence word of a document is looked up in the
postings of the templates, places are subtracted, and a
template is a candidate where enough of its words agree on where it would begin. It is reported if all its key phrases
stand at their places relative to that beginning. The base phrases are read off the same key phrase places.

Null and empty texts have no words and no labels. Repeated rows are judged alike, texts of any length whole. An empty
table gives no rows. Two columns are read, whatever the others are named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.quality_rules import bound
from tidemark.llm.staging import staged
from tidemark.llm.url_filter import ascii_lower

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose places are counted, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: (label, wording, key phrases): public licence notices in normalised words.
TEMPLATES = (
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation", ("redistribute it and or modify it", "free software foundation")),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
     ("gnu lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation",
     ("gnu affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", ("permission is hereby granted", "associated documentation files")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify and or distribute",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license 2 0",)),
    ("boost", "distributed under the boost software license version 1 0", ("boost software license version 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released",)),
    ("cc-by-nc", "licensed under cc by nc", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd", ("cc by nd",)),
    ("cc0", "licensed under cc0", ("cc0",)),
)
#: Words too frequent in any text to be looked up.
COMMON = set("the of and to in a is be any this under or by with for on without all that from as it you can are use into not "
             "person free 0 1 2 3 v following made form source".split())
AGREEING = 2


def rare_words(wording: str) -> list[tuple[str, int]]:
    return [(w, i) for i, w in enumerate(wording.split()) if w not in COMMON]


def vocabulary() -> list[str]:
    return sorted({w for _, wording, _ in TEMPLATES for w, _ in rare_words(wording)})


def key_phrases() -> list[tuple[str, str, int]]:
    """Every phrase that is looked for, with its first rare word and where that stands in it."""
    phrases = sorted({*BASE, *(p for _, _, keys in TEMPLATES for p in keys)})
    return [(p, *rare_words(p)[0]) for p in phrases]


def _phrase_places(words: Column, places: Column) -> Column:
    """(phrase, place) of every key phrase, found from the places of its first rare word."""
    def at(phrase: str, head: int):
        def whole(i):
            condition = F.lit(True)
            for k, word in enumerate(phrase.split()):
                condition = condition & F.coalesce(F.get(words, i + (k - head)) == word, F.lit(False))
            return condition

        return F.transform(F.filter(places, whole), lambda i: F.struct(F.lit(phrase).alias("phrase"), (i - head).alias("place")))

    return F.flatten(F.array(*[at(phrase, head) for phrase, _, head in key_phrases()]))


def indexed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, key, n_words, tokens, phrases) of every document."""
    lowered = ascii_lower(F.coalesce(docs[text], F.lit("")))
    words = F.array_remove(F.split(lowered, SEPARATORS), "")
    listed = vocabulary()

    def places_of(w):
        return F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i).isin(listed))

    def entry(w):
        return bound(places_of(w), lambda places: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.transform(places, lambda i: F.struct(F.get(w, i).alias("word"), i.alias("place"))).alias("tokens"),
            F.when(F.size(places) > 0, _phrase_places(w, places)).otherwise(
                F.array().cast("array<struct<phrase:string,place:int>>")).alias("phrases")))

    frame = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("key"), words.alias("words"))
    return frame.select("row", "key", bound(F.col("words"), entry).alias("e")).select("row", "key", "e.*")


def _literal(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A fixed table of template data as literals of the plan."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def _postings(spark: SparkSession) -> DataFrame:
    rows = [(label, word, place, len(rare_words(wording))) for label, wording, _ in TEMPLATES for word, place in rare_words(wording)]
    return _literal(spark, rows, ["label", "t_word", "t_place", "t_size"])


def _mandatory(spark: SparkSession) -> DataFrame:
    rows = []
    for label, wording, keys in TEMPLATES:
        for phrase in keys:
            before = f" {wording} ".split(f" {phrase} ")[0].split() if f" {phrase} " in f" {wording} " else None
            if before is None:
                raise ValueError(f"the key phrase of {label} is not part of its wording")
            rows.append((label, phrase, len(before), len(keys)))
    return _literal(spark, rows, ["m_label", "m_phrase", "m_place", "m_size"])


def matches(index: DataFrame) -> DataFrame:
    """(row, label, share) of every template found; share is the part of its rare words that agree."""
    spark = index.sparkSession
    tokens = index.where(F.size("tokens") > 0).select("row", F.explode("tokens").alias("t")).select("row", "t.*")
    aligned = tokens.join(_postings(spark), F.col("word") == F.col("t_word")).withColumn("begin", F.col("place") - F.col("t_place"))
    agreed = aligned.groupBy("row", "label", "begin", "t_size").agg(F.count_distinct("t_place").alias("agreeing"))
    agreed = agreed.where(F.col("agreeing") >= F.least(F.lit(AGREEING), F.col("t_size")))
    phrases = index.where(F.size("phrases") > 0).select(F.col("row").alias("p_row"), F.explode("phrases").alias("p")).select("p_row", "p.*")
    expected = phrases.join(_mandatory(spark), F.col("phrase") == F.col("m_phrase")).withColumn("p_begin", F.col("place") - F.col("m_place"))
    kept = expected.groupBy("p_row", "m_label", "p_begin", "m_size").agg(F.count_distinct("phrase").alias("kept")).where("kept = m_size")
    same = (F.col("row") == F.col("p_row")) & (F.col("label") == F.col("m_label")) & (F.col("begin") == F.col("p_begin"))
    return agreed.join(kept, same).select("row", "label", (F.col("agreeing") / F.col("t_size")).alias("share"))


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, base places and labels, all labels, and a score.

    The score is 1 with a base phrase, else the largest share of a template's rare words that agree, 0 without any.
    """
    index = staged(indexed(docs, key, text), "license-index")
    named = matches(index).groupBy(F.col("row").alias("l_row")).agg(F.collect_set("label").alias("own"), F.max("share").alias("share"))
    base = F.filter("phrases", lambda p: p.phrase.isin(list(BASE)))
    names = F.create_map(*[F.lit(x) for pair in BASE.items() for x in pair])
    frame = index.join(named, F.col("row") == F.col("l_row"), "left").withColumn("base", base)
    labels = F.array_distinct(F.transform("base", lambda p: names[p.phrase]))
    every = F.array_union(labels, F.coalesce("own", F.array().cast("array<string>")))
    starts = F.transform("base", lambda p: p.place)
    text_of = lambda labels: F.array_join(F.array_sort(labels), ",")
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return frame.select(
        "key", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), text_of(labels).alias("base_labels"), text_of(every).alias("labels"),
        score.alias("score"))
