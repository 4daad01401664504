"""Licence scan with a positional index of rare words.

Base labels come from fixed phrases whose words stand consecutively. Further labels
come from licence templates:

1. Every template is indexed under its words of highest IDF in the corpus, with
   their places in the template.
2. Each file is split into words once. If it holds all mandatory words of a template, all
   index words in it are looked up. Every occurrence votes for a template and an offset (place
   in the file less place in the template; negative where a template begins before the
   file does). Offsets on which different words agree are alignments.
3. At an alignment the template's mandatory key phrases must stand word by word; the
   share of the template's words that stand there is the alignment's score.

All of it is DataFrame expressions, joins and aggregates. Texts are never shuffled: what
stays of a file are the places of its template words.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut

#: Phrase and label.
PHRASES: list[tuple[str, str]] = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]  # mandatory, each standing in the text


#: Public licence wordings, in lower case without punctuation.
TEMPLATES: list[Template] = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files", ("permission is hereby granted", "free of charge")),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license", "version 2")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use", "source and binary forms")),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3",
             ("gnu general public license", "version 3")),
    Template("gpl-2", "this work is licensed under the gnu general public license version 2",
             ("gnu general public license", "version 2")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
             ("creative commons attribution",)),
    Template("proprietary", "all rights reserved no part of this publication may be reproduced",
             ("all rights reserved",)),
]
INDEX_WORDS = 6  # of a template
AGREE = 2  # different words that make an alignment

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null counts as empty."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), 0)


def _places(words: Column, n: Column, phrase: str) -> Column:
    """struct(n, first, last) of the places where the phrase's words stand in a row."""
    parts = F.split(F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" ")), f" {phrase.replace(' ', '  ')} ")

    def count(part: Column) -> Column:  # each word stands between two blanks of its own
        return ((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2).cast("bigint")

    found = F.size(parts) - 1
    some = F.struct(found.cast("bigint").alias("n"), count(F.element_at(parts, 1)).alias("first"),
                    (n - count(F.element_at(parts, -1)) - len(phrase.split())).alias("last"))
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("first"),
                    F.lit(None).cast("bigint").alias("last"))
    # The texts are joined up only where the phrase's first and last word occur at all.
    likely = F.array_contains(words, phrase.split()[0]) & F.array_contains(words, phrase.split()[-1])
    return F.when(likely, F.when(found > 0, some).otherwise(none)).otherwise(none)


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: list[tuple[str, str]] = PHRASES,
         templates: list[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, one
    row for each row of ``df``.

    score: 1.0 with a base place, else the best alignment's share of template words,
    else 0.0. Without places first_word and last_word are null, without labels the
    strings are empty. Null and empty texts have no words. Rows that agree in id and
    text get the same result, rows without an id are judged like others. Other columns
    are not read."""
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .select("doc_id", F.xxhash64("doc_id", "text").alias("key"), words_of(F.col("text")).alias("words"))
    words, n = F.col("words"), F.size("words").cast("bigint")
    vocabulary = sorted({w for t in templates for w in t.text.split()})

    # Texts are split into words once. Of each file stay: its number of words, its base
    # places, the templates' words it holds and, if all mandatory words of a template
    # are among them, where these words stand.
    def places(present: Column) -> Column:
        mandatory = [F.size(F.array_except(_strings(sorted({w for p in t.phrases for w in p.split()})), present)) == 0 for t in templates]
        some = mandatory[0]
        for m in mandatory[1:]:
            some |= m
        at = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(present, w), F.struct(i.alias("at"), w.alias("word")))),
                      lambda x: x.isNotNull())
        return F.struct(present.alias("present"), F.when(some, at).alias("hits"))

    found = F.element_at(F.transform(F.array(F.array_intersect(_strings(vocabulary), words)), places), 1)
    files = cut(docs.select("doc_id", "key", n.alias("n_words"), found.alias("found"),
                            *(_places(words, n, p).alias(f"p{k}") for k, (p, _) in enumerate(phrases))))

    # Document frequencies of the templates' words: as many rows as these have words.
    df_of = {r["w"]: r["n"] for r in files.select(F.explode("found.present").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (df_of.get(w, 0), w)))}
    index = {t.label: sorted(set(t.text.split()), key=rank.get)[:INDEX_WORDS] for t in templates}

    # Postings of all template words; those of the rarest vote. An alignment is kept as
    # two sets of bits: template places that match, and index words that agree.
    entries = []
    for k, t in enumerate(templates):
        for i, w in enumerate(t.text.split()):
            vote = 1 << index[t.label].index(w) if w in index[t.label] else 0
            entries.append(f"struct('{w}' AS word, {k} AS template, {i} AS place, {1 << i}L AS bit, {vote} AS vote)")
    postings = df.sparkSession.range(1).select(F.inline(F.expr(f"array({', '.join(entries)})")))  # one row a template word
    hits = files.where("found.hits IS NOT NULL").select("key", F.inline("found.hits"))
    aligned = hits.join(F.broadcast(postings), "word").groupBy("key", "template", (F.col("at") - F.col("place")).alias("offset")) \
        .agg(F.bit_or("bit").alias("stands"), F.bit_or("vote").alias("agree")).where(F.bit_count("agree") >= AGREE)

    # The mandatory phrases at the alignments, and the share of the template that stands there.
    # A template can begin before the file does; its words there are missing.
    def of_template(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("template") + 1)

    must = of_template([sum(((1 << len(p.split())) - 1) << _find(t.text.split(), p.split()) for p in _apart(t)) for t in templates]).cast("bigint")
    verified = aligned.where(F.col("stands").bitwiseAND(must) == must).groupBy("key").agg(
        F.collect_set(of_template([t.label for t in templates])).alias("more"),
        F.max(F.bit_count("stands") / of_template([len(t.text.split()) for t in templates])).alias("best"))

    each = [F.col(f"p{k}") for k in range(len(phrases))]
    firsts, lasts = F.array(*(p["first"] for p in each)), F.array(*(p["last"] for p in each))
    own_labels = F.filter(F.array(*(F.when(p["n"] > 0, F.lit(v)) for p, (_, v) in zip(each, phrases, strict=True))),
                          lambda x: x.isNotNull())
    base = files.select("doc_id", "key", "n_words", sum((p["n"] for p in each), F.lit(0).cast("bigint")).alias("n_base"),
                        F.array_min(firsts).alias("first_word"), F.array_max(lasts).alias("last_word"),
                        F.array_sort(F.array_distinct(own_labels)).alias("own"))
    return base.join(verified, "key", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def _apart(t: Template) -> list[str]:
    """The mandatory phrases; sets of bits can be added if none overlap."""
    at = sorted((_find(t.text.split(), p.split()), len(p.split())) for p in t.phrases)
    if any(a + n > b for (a, n), (b, _) in zip(at, at[1:], strict=False)) or len(t.text.split()) > 62:
        raise ValueError(f"template {t.label!r}: phrases overlap or it has more than 62 words")
    return list(t.phrases)


def _find(words: list[str], phrase: list[str]) -> int:
    """Where a mandatory phrase stands in its template."""
    for i in range(len(words) - len(phrase) + 1):
        if words[i:i + len(phrase)] == phrase:
            return i
    raise ValueError(f"not in its template: {' '.join(phrase)}")


def oracle_sql(phrases: list[tuple[str, str]] = PHRASES, templates: list[Template] = TEMPLATES) -> str:
    """DuckDB SQL of ``scan`` over ``documents``."""
    def rows(values: list[tuple]) -> str:
        return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in values)

    cond = {k: " AND ".join(f"o + {_find(t.text.split(), p.split())} >= 0 AND array_slice(words, o + {_find(t.text.split(), p.split()) + 1}, "
                            f"o + {_find(t.text.split(), p.split()) + len(p.split())}) = {p.split()}" for p in t.phrases)
            for k, t in enumerate(templates)}
    verify = " ".join(f"WHEN t = {k} THEN {c}" for k, c in cond.items())
    return f"""
WITH d AS (SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
r AS (SELECT row_number() OVER () AS rid, doc_id, words FROM d),
w AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM r),
phrase(p, label, words, size) AS (VALUES {", ".join(f"({k}, '{v}', {p.split()}, {len(p.split())})" for k, (p, v) in enumerate(phrases))}),
place AS (SELECT rid, pos, label FROM w JOIN r USING (rid) JOIN phrase ON w.word = phrase.words[1]
          AND array_slice(r.words, pos + 1, pos + size) = phrase.words),
base AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS own
         FROM place GROUP BY rid),
tw(t, i, word) AS (VALUES {rows([(k, i, x) for k, t in enumerate(templates) for i, x in enumerate(t.text.split())])}),
tn(t, label) AS (VALUES {rows([(k, t.label) for k, t in enumerate(templates)])}),
freq AS (SELECT v.word, count(DISTINCT rid) AS df FROM (SELECT DISTINCT word FROM tw) v LEFT JOIN w USING (word) GROUP BY v.word),
ranked AS (SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY df, word) AS k
           FROM (SELECT DISTINCT t, word FROM tw) JOIN freq USING (word)),
posting AS (SELECT t, i, word FROM tw JOIN ranked USING (t, word) WHERE k <= {INDEX_WORDS}),
vote AS (SELECT rid, t, pos - i AS o, count(DISTINCT word) AS agree FROM w JOIN posting USING (word)
         GROUP BY ALL HAVING count(DISTINCT word) >= {AGREE}),
good AS (SELECT rid, t, o FROM vote JOIN r USING (rid) WHERE CASE {verify} END),
share AS (SELECT rid, t, o, count(*) FILTER (o + i >= 0 AND tw.word = r.words[o + i + 1]) / count(*) AS score
          FROM good JOIN tw USING (t) JOIN r USING (rid) GROUP BY ALL),
more AS (SELECT rid, list(DISTINCT label) AS more, max(score) AS best FROM share JOIN tn USING (t) GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0) END AS score
FROM r LEFT JOIN base USING (rid) LEFT JOIN more USING (rid)
"""
