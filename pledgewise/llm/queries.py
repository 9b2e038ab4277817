"""The registered queries of this subpackage and, where SQL can express one, the same rows in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import codes, decontaminate, language, lexical, linededup, lm, media, quality, sentencepieces, simhash, substrings, topk, toxicity
from .common import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_texts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_texts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_and_check(read(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest_rows(substrings.dedup_substrings(read(spark, sf_dir, "documents")))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.encode(read(spark, sf_dir, "embeddings"))[0].drop("label")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_quality,
        op3_language_id,
        op4_line_dedup,
        op5_lm_scoring,
        op6_simhash,
        op7_media,
        op8_decontamination,
        op9_sentencepiece,
        op10_substring_dedup,
        op11_topk,
        op12_vector_codes,
        op13_lexical_search,
    )
}

#: A-Z to a-z alone.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_USABLE = "embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"


def _codes_sql(rounds: int = 4, entries: int = 256) -> str:
    """The rounds one after another: assignments ``a0`` to ``a4``, codebooks ``b0`` to ``b4``."""
    ctes = [
        f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {_USABLE})""",
        """parts AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM kept, range(4) AS t(p))""",
        f"""b0 AS MATERIALIZED (SELECT p, e, x FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts) WHERE e < {entries})""",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"""a{r} AS MATERIALIZED (SELECT vec_id, p, any_value(x) AS x, min(d) AS d, arg_min(e, (d, e)) AS e FROM (SELECT parts.vec_id, parts.p, parts.x, b.e,
            list_sum(list_transform(range(1, len(b.x) + 1), lambda i: (parts.x[i] - b.x[i]) * (parts.x[i] - b.x[i])))::BIGINT AS d FROM parts JOIN b{r} AS b ON parts.p = b.p) GROUP BY vec_id, p)"""
        )
        if r < rounds:
            ctes.append(
                f"""b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{r} AS b LEFT JOIN (SELECT p, e, list(floor(s / n)::BIGINT ORDER BY i) AS x
            FROM (SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY p, e, i) GROUP BY p, e) AS m ON b.p = m.p AND b.e = m.e)"""
            )
    return f"""WITH {", ".join(ctes)},
        digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
        coded AS (SELECT vec_id, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (vec_id), digest"""


ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": """
        WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
        w AS (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS p FROM d WHERE len(lines) >= 3),
        k AS (SELECT doc_id, p, lines[p + 1] AS a, lines[p + 2] AS b, lines[p + 3] AS c FROM w),
        later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS n
                  FROM k WHERE trim(a) || trim(b) || trim(c) <> '') WHERE n > 1),
        gone AS (SELECT DISTINCT doc_id, p + o AS p FROM later, (VALUES (0), (1), (2)) AS t(o)),
        n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
        kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.p) AS text
                 FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS p FROM d) l
                 ANTI JOIN gone USING (doc_id, p) GROUP BY l.doc_id)
        SELECT d.doc_id, coalesce(len(d.lines), 0)::BIGINT AS n_lines, coalesce(n.n, 0)::BIGINT AS n_removed,
               CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op8_decontamination": f"""
        WITH d AS (SELECT doc_id, coalesce({_ITEM_WORDS}, []) AS words FROM documents),
        i AS (SELECT item_id, coalesce({_ITEM_WORDS}, []) AS words FROM benchmark),
        iw AS (SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(words[p + 1 : p + 13], ' ') AS phrase
               FROM (SELECT item_id, words, unnest(range(0, greatest(len(words) - 12, CASE WHEN len(words) > 0 THEN 1 ELSE 0 END))) AS p FROM i)),
        sizes AS (SELECT DISTINCT n FROM iw),
        dw AS (SELECT doc_id, n, p, array_to_string(words[p + 1 : p + n], ' ') AS phrase
               FROM (SELECT doc_id, words, n, unnest(range(0, greatest(len(words) - n + 1, 0))) AS p FROM d, sizes)),
        hits AS (SELECT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.phrase = iw.phrase),
        covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(x.n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(x.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.words) AS contaminated
        FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items x USING (doc_id)""",
    "op10_substring_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
        w AS (SELECT doc_id, p, array_to_string(words[p + 1 : p + 13], ' ') AS phrase
              FROM (SELECT doc_id, words, unnest(range(0, greatest(len(words) - 12, 0))) AS p FROM d)),
        later AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY phrase) AS least FROM w) WHERE least < doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM later),
        n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
        kept AS (SELECT l.doc_id, string_agg(l.word, ' ' ORDER BY l.p) AS text
                 FROM (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS p FROM d) l
                 ANTI JOIN gone USING (doc_id, p) GROUP BY l.doc_id)
        SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op11_topk": f"""
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {_USABLE}),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
              FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 5""",
    "op12_vector_codes": _codes_sql(),
    "op13_lexical_search": f"""
        WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
        i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
        size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
        f AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM i) GROUP BY doc_id, term),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM f GROUP BY term), total),
        m AS (SELECT doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM size, total),
        s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
              FROM i JOIN w USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
        SELECT item_id, rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0) WHERE rank <= 10""",
}
