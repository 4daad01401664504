"""Ranked lexical search by the Best Position Algorithm.

1. One pass counts documents, terms and the document frequency of the queries' terms;
   weights follow from these counts over the whole corpus.
2. A second pass deals the documents into shards of bounded size. For every query
   term a shard holds an impact list: its documents by falling impact, ties by id.
3. A query reads its lists in parallel from the top. Each new document's whole score is
   found by direct accesses, which also mark its positions in all lists. The best
   position of a list is the last of the unbroken run of seen positions from its top,
   however they were seen; the impacts there bound every unseen document. Reading
   stops as soon as that bound is strictly below the k-th score found.
4. The best of all shards are the result.

Scores are integers; only the weight's logarithm is a double.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm.shingles import NOT_ALNUM, word_hashes

BASE, SLOPE = 25, 75  # percent of the length norm that is fixed, and that follows the length
SCALE = 1_000_000_000


def term_counts(data: np.ndarray, ends: np.ndarray, vocabulary: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text; and, sorted by text, the texts, places in the sorted
    ``vocabulary`` and counts of the terms that stand in it."""
    terms, length = word_hashes(data, ends, NOT_ALNUM)
    place = np.minimum(np.searchsorted(vocabulary, terms), max(len(vocabulary) - 1, 0))
    hit = np.flatnonzero(vocabulary[place] == terms) if len(vocabulary) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(length)), length)[hit]
    code, count = np.unique(owner * max(len(vocabulary), 1) + place[hit], return_counts=True)
    return length, code // max(len(vocabulary), 1), code % max(len(vocabulary), 1), count


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) of each term."""
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    norm = BASE + SLOPE * length * n_docs // max(n_terms, 1)
    return SCALE * tf // (1000 * tf + 8 * norm)


class Shard:
    """Impact lists of some documents, with direct access."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, vocabulary: int) -> None:
        self.ids = ids
        order = np.lexsort((doc, term))
        self.key = term[order] * len(ids) + doc[order]  # sorted: by term, by document
        self.impact = impact[order]
        best = np.lexsort((ids[doc[order]], -self.impact, term[order]))
        self.doc = doc[order][best]  # by term, by falling impact
        self.by_rank = self.impact[best]
        self.rank = np.empty(len(best), dtype=np.int64)
        self.rank[best] = np.arange(len(best))
        self.start = np.searchsorted(term[order], np.arange(vocabulary + 1))
        self.seen = np.zeros(len(best), dtype=np.int64)  # number of the query that saw the position
        self.queries = 0

    def search(self, terms: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k`` documents (numbers) and their scores above 0; times: each
        term's weight times its occurrences in the query."""
        self.queries += 1
        keep = (self.start[terms + 1] > self.start[terms]) & (times > 0)
        terms, times = terms[keep], times[keep]
        lo, size = self.start[terms], self.start[terms + 1] - self.start[terms]
        n = len(terms)
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        if not n:
            return docs, scores
        met = np.empty(0, np.int64)  # all documents seen, sorted
        best = np.zeros(n, dtype=np.int64)  # length of each list's run of seen positions
        read, step = 0, 8
        while True:
            at = read + np.arange(step)
            cells = (lo[:, None] + at)[at < size[:, None]]
            read, step = read + step, min(2 * step, 4096)
            fresh = np.setdiff1d(self.doc[cells], met)
            if len(fresh):
                met = np.union1d(met, fresh)
                key = (terms[:, None] * len(self.ids) + fresh).ravel()
                place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
                has = self.key[place] == key
                self.seen[self.rank[place[has]]] = self.queries
                gain = np.where(has, self.impact[place], 0).reshape(n, -1)
                docs = np.concatenate([docs, fresh])
                scores = np.concatenate([scores, times @ gain])
                top = np.lexsort((self.ids[docs], -scores))[:k]
                docs, scores = docs[top], scores[top]
            for j in range(n):
                while best[j] < size[j]:
                    ahead = self.seen[lo[j] + best[j]:lo[j] + min(best[j] + 256, size[j])] == self.queries
                    run = len(ahead) if ahead.all() else int(ahead.argmin())
                    best[j] += run
                    if run < len(ahead):
                        break
            last = np.where(best == size, 0, self.by_rank[lo + np.maximum(best - 1, 0)])
            bound = int(times @ last)
            if (len(docs) == k and bound < scores[-1]) or (best == size).all():
                some = scores > 0
                return docs[some], scores[some]


def _queries(items: list[tuple[int, bytes]]) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Vocabulary of the items, and each item's terms (places in it) with their numbers of occurrences."""
    words, length = word_hashes(np.frombuffer(b"".join(t for _, t in items), np.uint8),
                                np.cumsum([len(t) for _, t in items], dtype=np.int64), NOT_ALNUM)
    vocabulary = np.unique(words)
    ends = np.cumsum(length)
    out = []
    for (item, _), n, end in zip(items, length.tolist(), ends.tolist(), strict=True):
        terms, times = np.unique(np.searchsorted(vocabulary, words[end - n:end]), return_counts=True)
        out.append((item, terms, times))
    return vocabulary, out


def _portions(queries: DataFrame, portion_bytes: int) -> Iterator[tuple[list[tuple[int, bytes]], bool]]:
    """The distinct items in portions of bounded size for the driver, and whether there are several."""
    items = queries.where("text IS NOT NULL").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // portion_bytes)) if total > portion_bytes else 1
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1].encode()) for r in own.orderBy("item_id", "text").collect()], n > 1


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text", portion_bytes: int = 8 << 20,
           shard_postings: int = 1 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 for
    each query text, ties to the smaller id.

    Terms are maximal runs of ASCII letters and digits and of all other characters
    beyond ASCII, A-Z lower-cased, compared by 64-bit fingerprints. Null and empty
    texts have no terms: as documents they do not count, as queries they find nothing.
    A document without an id counts in the statistics and is not ranked. A repeated
    document is ranked as often as it stands there; a query listed twice is one, and
    an item id with several texts is answered for each text. Other columns are not read. Queries are
    broadcast in portions of at most ``portion_bytes``, two passes over the documents
    for each; a shard holds about ``shard_postings`` postings, some 150 bytes each."""
    spark = docs.sparkSession
    texts = common.narrow(docs, id_col, text_col)
    asked = queries.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(query_col).cast("string").alias("text"))
    out = None
    for items, several in _portions(asked, portion_bytes):
        vocabulary, wanted = _queries(items)
        terms = spark.sparkContext.broadcast(vocabulary)
        n_docs, n_terms, df = _statistics(texts, terms)
        index = spark.sparkContext.broadcast((vocabulary, n_docs, n_terms,
                                              [(number, t, times * weights(df[t], n_docs)) for number, (_, t, times) in enumerate(wanted)]))
        own = common.map_arrow(texts.where("doc_id IS NOT NULL"), _searcher(index, k, shard_postings),
                               "query bigint, doc_id bigint, score bigint")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        # One row a query, at most portion_bytes of texts.
        names = spark.createDataFrame([(number, item) for number, (item, _, _) in enumerate(wanted)], "query bigint, item_id bigint")
        ranked = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
            .join(names, "query").select("item_id", "rank", "doc_id", "score")
        if several:  # one portion at a time is held
            ranked = common.cut(ranked)
            terms.destroy()
            index.destroy()
        out = ranked if out is None else out.union(ranked)
    return out


def _statistics(texts: DataFrame, terms) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and the document frequency of each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = terms.value
        df, n_docs, n_terms = np.zeros(len(vocabulary), dtype=np.int64), 0, 0
        for batch in batches:
            for part in common.pieces(batch, 2 << 20):
                length, _, place, _ = term_counts(*common.text_bytes(part.column("text")), vocabulary)
                n_docs, n_terms = n_docs + int((length > 0).sum()), n_terms + int(length.sum())
                df += np.bincount(place, minlength=len(df))[:len(df)]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some])),
                                          pa.array(np.concatenate([[n_docs, n_terms], df[some]]).astype(np.int64))],
                                         names=["term", "n"])

    # One row for each term of the queries' vocabulary.
    rows = common.map_arrow(texts.select("text"), run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect()
    counts = {t: n for t, n in rows}
    df = np.zeros(len(terms.value), dtype=np.int64)
    for t, n in counts.items():
        if t >= 0:
            df[t] = n
    return counts.get(-2, 0), counts.get(-1, 0), df


def _searcher(index, k: int, shard_postings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, n_docs, n_terms, queries = index.value
        held: list[tuple[np.ndarray, ...]] = []
        n_ids = n_held = 0

        def answered() -> pa.RecordBatch:
            ids, doc, term, impact = (np.concatenate(c) for c in zip(*held, strict=True))
            shard = Shard(ids, doc, term, impact, len(vocabulary))
            found = [(np.full(len(d), q), shard.ids[d], score)
                     for q, terms, times in queries for d, score in [shard.search(terms, times, k)]]
            cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query", "doc_id", "score"])

        for batch in batches:
            for part in common.pieces(batch, 2 << 20):
                length, doc, term, tf = term_counts(*common.text_bytes(part.column("text")), vocabulary)
                some, doc = np.unique(doc, return_inverse=True)  # only documents with a term of a query
                held.append((part.column("doc_id").to_numpy()[some], doc + n_ids, term,
                             impacts(tf, length[some][doc], n_docs, n_terms)))
                n_ids, n_held = n_ids + len(some), n_held + len(doc)
                if n_held >= shard_postings:
                    yield answered()
                    held, n_ids, n_held = [], 0, 0
        if n_held:
            yield answered()

    return run


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
tf AS (SELECT rid, doc_id, len(terms)::BIGINT AS n, t.term, count(*)::BIGINT AS tf
       FROM d, unnest(d.terms) AS t(term) GROUP BY rid, doc_id, n, t.term),
q AS (SELECT item_id, qid, t.term, count(*)::BIGINT AS times
      FROM (SELECT row_number() OVER () AS qid, * FROM (SELECT DISTINCT item_id, text FROM benchmark)
            ) AS b, unnest({_TERMS}) AS t(term) GROUP BY item_id, qid, t.term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term) CROSS JOIN s),
scored AS (SELECT q.item_id, q.qid, tf.rid, tf.doc_id, sum(q.times * w.w * ((1000000000 * tf.tf)
              // (1000 * tf.tf + 8 * (100 - 75 + (75 * tf.n * s.n_docs) // s.n_terms))))::BIGINT AS score
           FROM q JOIN tf USING (term) JOIN w USING (term) CROSS JOIN s WHERE tf.doc_id IS NOT NULL
           GROUP BY q.item_id, q.qid, tf.rid, tf.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
