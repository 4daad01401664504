"""URL filter: rules first, a character language-model ratio for the rest.

URLs that a rule allows or blocks train one variable-order Markov model each. A
character's probability after its last ``ORDER`` characters is interpolated with
that after one character less (Witten-Bell: the more different characters followed
a context, the more weight the shorter context gets), down to single characters.
A URL's score is its log-likelihood difference between the two models, divided by
its length. The cut lies between the two classes' mean scores, closer to the class
of smaller spread. URLs without a rule are allowed from the cut on.

All of it is DataFrame expressions, joins and aggregates.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut

ORDER = 3
PAD = "^"  # before the first character; no character of a text
ALPHABET = 34  # a-z, 0 for any digit, seven signs (* for every other character)

#: (verdict, host, path)
Rule = tuple[str, str, str]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or #, A-Z lower-cased; path: then up to ?
    or #. Both empty for null and without ://."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. A rule fits its host
    and all subdomains, where the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _model(counts: DataFrame) -> DataFrame:
    """(gram, ratio) from (gram, a, r): the gram's counts in accepted and rejected
    URLs; ratio: log of the two probabilities of its last character."""
    levels = {ORDER + 1: counts}
    for n in range(ORDER, 0, -1):
        levels[n] = levels[n + 1].groupBy(F.substring("gram", 2, n).alias("gram")).agg(
            F.sum("a").alias("a"), F.sum("r").alias("r"))
    total = levels[1].agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    na, nr = (x or 0 for x in total.first())
    p = levels[1].select("gram", ((F.col("a") + 1) / (na + ALPHABET)).alias("pa"),
                         ((F.col("r") + 1) / (nr + ALPHABET)).alias("pr"))
    for n in range(2, ORDER + 2):
        context = F.substring("gram", 1, n - 1)
        seen = levels[n].groupBy(context.alias("context")).agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"),
            F.sum((F.col("a") > 0).cast("int")).alias("ta"), F.sum((F.col("r") > 0).cast("int")).alias("tr"))
        shorter = p.select(F.col("gram").alias("tail"), F.col("pa").alias("sa"), F.col("pr").alias("sr"))
        joined = levels[n].withColumn("context", context).withColumn("tail", F.substring("gram", 2, n - 1)) \
            .join(seen, "context").join(shorter, "tail")

        def mixed(count: str, of: str, kinds: str, less: str) -> Column:
            return F.when(F.col(of) > 0, (F.col(count) + F.col(kinds) * F.col(less)) / (F.col(of) + F.col(kinds))) \
                .otherwise(F.col(less))

        p = joined.select("gram", mixed("a", "na", "ta", "sa").alias("pa"), mixed("r", "nr", "tr", "sr").alias("pr"))
    return p.select("gram", (F.log("pa") - F.log("pr")).alias("ratio"))


def judge(df: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, score: one row for each row.

    Null URLs and those without :// have an empty host and path; they fit no rule
    and, having nothing to judge, are blocked. Without URLs of both kinds to learn
    from, URLs without a rule are allowed. Equal URLs count once in the models,
    whatever number of rows they have. Other columns are not read."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    parsed = df.select(F.col(id_col).cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    text = F.regexp_replace(F.regexp_replace(ascii_lower(F.concat("host", "path")), "[0-9]", "0"), "[^a-z0/._%~-]", "*")
    parsed = parsed.select("*", rule.alias("rule"), said.alias("said"), text.alias("text")) \
        .withColumn("key", F.xxhash64("text", "said"))
    urls = parsed.where("text <> ''").groupBy("key").agg(F.min("text").alias("text"), F.min("said").alias("said"))
    padded = F.concat(F.lit(PAD * ORDER), F.col("text"))
    grams = urls.select("key", "said", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("text")), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))).alias("gram"))
    counts = cut(grams.groupBy("gram").agg(F.sum((F.col("said") == "allow").cast("bigint")).alias("a"),
                                           F.sum((F.col("said") == "block").cast("bigint")).alias("r"))
                 .fillna(0))
    scores = cut(grams.select("key", "said", "gram").join(_model(counts), "gram").groupBy("key")
                 .agg(F.avg("ratio").alias("score"), F.min("said").alias("said")))
    spread = {r["said"]: (r["mean"], r["sd"]) for r in scores.where("said IS NOT NULL").groupBy("said").agg(
        F.avg("score").alias("mean"), F.stddev_pop("score").alias("sd")).collect()}
    if "allow" in spread and "block" in spread:
        (ma, sa), (mr, sr) = spread["allow"], spread["block"]
        sa, sr = sa + 1e-9, sr + 1e-9
        fine = F.col("score") >= (ma * sr + mr * sa) / (sa + sr)
    else:
        fine = F.col("score").isNotNull()
    own = F.when(fine, "allow").otherwise("block")
    return parsed.drop("text").join(scores.select("key", "score"), "key", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("said", own).alias("verdict"), "score")


PAGE_RULES: list[Rule] = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]

#: DuckDB SQL of the query over ``pages`` with PAGE_RULES.
ORACLE_SQL = """
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS x
              FROM pages),
parsed AS (SELECT page_id, translate(regexp_extract(x, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(says, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
                      ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
places AS (SELECT DISTINCT host, path FROM parsed),
fits AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(says, length(h || p)) AS said
         FROM places JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL),
texts AS (SELECT host, path, rule, said, regexp_replace(regexp_replace(translate(host || path,
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'), '[^a-z0/._%~-]', '*', 'g') AS t
          FROM places LEFT JOIN fits USING (host, path)),
urls AS (SELECT DISTINCT t, said FROM texts WHERE t <> ''),
grams AS (SELECT t, said, substr('^^^' || t, i, 4) AS g
          FROM (SELECT t, said, unnest(generate_series(1, length(t))) AS i FROM urls)),
c4 AS (SELECT g, count(*) FILTER (said = 'allow') AS a, count(*) FILTER (said = 'block') AS r FROM grams GROUP BY g),
c3 AS (SELECT substr(g, 2) AS g, sum(a) AS a, sum(r) AS r FROM c4 GROUP BY ALL),
c2 AS (SELECT substr(g, 2) AS g, sum(a) AS a, sum(r) AS r FROM c3 GROUP BY ALL),
c1 AS (SELECT substr(g, 2) AS g, sum(a) AS a, sum(r) AS r FROM c2 GROUP BY ALL),
p1 AS (SELECT g, (a + 1) / (sum(a) OVER () + 34) AS pa, (r + 1) / (sum(r) OVER () + 34) AS pr FROM c1),
w2 AS (SELECT g, a, r, sum(a) OVER w AS na, sum(r) OVER w AS nr, sum((a > 0)::int) OVER w AS ta,
       sum((r > 0)::int) OVER w AS tr FROM c2 WINDOW w AS (PARTITION BY left(g, 1))),
p2 AS (SELECT w2.g, CASE WHEN na > 0 THEN (a + ta * pa) / (na + ta) ELSE pa END AS pa,
       CASE WHEN nr > 0 THEN (r + tr * pr) / (nr + tr) ELSE pr END AS pr FROM w2 JOIN p1 ON substr(w2.g, 2) = p1.g),
w3 AS (SELECT g, a, r, sum(a) OVER w AS na, sum(r) OVER w AS nr, sum((a > 0)::int) OVER w AS ta,
       sum((r > 0)::int) OVER w AS tr FROM c3 WINDOW w AS (PARTITION BY left(g, 2))),
p3 AS (SELECT w3.g, CASE WHEN na > 0 THEN (a + ta * pa) / (na + ta) ELSE pa END AS pa,
       CASE WHEN nr > 0 THEN (r + tr * pr) / (nr + tr) ELSE pr END AS pr FROM w3 JOIN p2 ON substr(w3.g, 2) = p2.g),
w4 AS (SELECT g, a, r, sum(a) OVER w AS na, sum(r) OVER w AS nr, sum((a > 0)::int) OVER w AS ta,
       sum((r > 0)::int) OVER w AS tr FROM c4 WINDOW w AS (PARTITION BY left(g, 3))),
p4 AS (SELECT w4.g, CASE WHEN na > 0 THEN (a + ta * pa) / (na + ta) ELSE pa END AS pa,
       CASE WHEN nr > 0 THEN (r + tr * pr) / (nr + tr) ELSE pr END AS pr FROM w4 JOIN p3 ON substr(w4.g, 2) = p3.g),
scores AS (SELECT t, said, avg(ln(pa) - ln(pr)) AS score FROM grams JOIN p4 USING (g) GROUP BY t, said),
spread AS (SELECT avg(score) FILTER (said = 'allow') AS ma, coalesce(stddev_pop(score) FILTER (said = 'allow'), 0) + 1e-9 AS sa,
           avg(score) FILTER (said = 'block') AS mr, coalesce(stddev_pop(score) FILTER (said = 'block'), 0) + 1e-9 AS sr
           FROM scores),
own AS (SELECT t, CASE WHEN ma IS NULL OR mr IS NULL OR score >= (ma * sr + mr * sa) / (sa + sr) THEN 'allow'
        ELSE 'block' END AS v FROM scores, spread WHERE said IS NULL)
SELECT page_id, host, path, rule, coalesce(said, v, 'block') AS verdict
FROM parsed JOIN texts USING (host, path) LEFT JOIN own USING (t)
"""
