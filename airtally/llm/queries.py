"""One registered query for each operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.llm import (
    ann, bpe, brown, collocations, fingerprints, htmltree, jaccard, langid, lines, packing, pagelayouts, quality, tokencounts, whitening,
)
from airtally.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; every executor has the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


#: What every sequence holds at most, and the id that ends a document.
SEQUENCE = 4096
END_ID = 2


@query
def op1_quality_rules(spark, sf_dir):
    """Quality of every text by the rule ensemble; rows whose remainder is 1 teach nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op2_pack_documents(spark, sf_dir):
    """All documents' ids in sequences of at most 4096."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), END_ID, SEQUENCE)


@query
def op3_prefix_fingerprints(spark, sf_dir):
    """Fingerprints of every text and of its edited text."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op4_ngram_jaccard(spark, sf_dir):
    """Components of documents whose sets of three-word shingles are at least 90 % alike."""
    return jaccard.link_documents(table(spark, sf_dir, "documents"), width=3, percent=90)


@query
def op5_brown_classes(spark, sf_dir):
    """Every text's log10 probability by the class model; rows whose remainder is 1 teach nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counted = brown.fit(docs.where(remainder("doc_id", 5) != 1))
    return brown.score(docs, model, counted).select(
        "doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


@query
def op6_byte_cnn(spark, sf_dir):
    """The language of every text; rows whose remainder is 0 teach nothing."""
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs.where(remainder("doc_id", 5) != 0))
    return langid.identify(docs, net).withColumn("held_out", remainder("doc_id", 5) == 0)


@query
def op7_bpe_round_trip(spark, sf_dir):
    """Every text encoded by the segment tree and decoded again, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op8_pruned_graph(spark, sf_dir):
    """The ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query
def op9_repeated_lines(spark, sf_dir):
    """Every text without the later copies of repeated runs of lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs, deleted_col="n_deleted")


@query
def op10_token_counts(spark, sf_dir):
    """Exact token count of every text, and whether it is over 1024."""
    counts = tokencounts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op11_page_text(spark, sf_dir):
    """The main text of every page by the page model."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltree.main_text(pages, htmltree.fit(pagelayouts.labelled_pages()))


@query
def op12_phrases(spark, sf_dir):
    """The 2000 phrases of each language whose words stand together most."""
    return collocations.phrases(table(spark, sf_dir, "documents"))


@query
def op13_whitened(spark, sf_dir):
    """Eight whitened components of every usable vector, and how well they are whitened."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


ORACLES["op4_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [w]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) END) AS shingles
    FROM words
), rows AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, len(s.shingles) AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reached r ON s.doc_id = r.a
GROUP BY s.doc_id, len(s.shingles)
"""

ORACLES["op9_repeated_lines"] = r"""
WITH texts AS (
    SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
), places AS (
    SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line FROM texts
), lines AS (
    SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM places
), counted AS (
    SELECT *, row_number() OVER d AS seq, sum(words) OVER d AS upto
    FROM lines WHERE words > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), ends AS (
    SELECT a.doc_id, a.seq AS i, min(b.seq) AS j
    FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.words >= {min_words}
    GROUP BY ALL
    UNION
    SELECT b.doc_id, max(a.seq), b.seq
    FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.words >= {min_words}
    GROUP BY b.doc_id, b.seq
), runs AS (
    SELECT e.doc_id, e.i, e.j, list(c.line ORDER BY c.seq) AS content, min(c.pos) AS first_pos, max(c.pos) AS last_pos
    FROM ends e JOIN counted c ON c.doc_id = e.doc_id AND c.seq BETWEEN e.i AND e.j
    GROUP BY e.doc_id, e.i, e.j
), firsts AS (
    SELECT content, min((doc_id, i)) AS kept FROM runs GROUP BY content
), gone AS (
    SELECT DISTINCT r.doc_id, unnest(range(r.first_pos, r.last_pos + 1)) AS pos
    FROM runs r JOIN firsts f ON r.content = f.content
    WHERE (r.doc_id, r.i) > f.kept AND (r.doc_id <> f.kept[1] OR r.i >= f.kept[2] + len(r.content))
)
SELECT d.doc_id, any_value(d.text) AS new_text_unused, count(g.pos) AS n_deleted,
    CASE WHEN any_value(d.text) IS NULL THEN NULL
         WHEN count(g.pos) = 0 THEN any_value(d.text)
         ELSE coalesce(string_agg(p.line, chr(10) ORDER BY p.pos) FILTER (g.pos IS NULL), '') END AS text
FROM documents d
LEFT JOIN places p ON p.doc_id = d.doc_id
LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos
GROUP BY d.doc_id
""".replace("{min_words}", str(lines.MIN_WORDS)).replace("any_value(d.text) AS new_text_unused, ", "")

ORACLES["op12_phrases"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), runs AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), f1 AS (
    SELECT lang, w1, count(*) AS f FROM (SELECT lang, unnest(w) AS w1 FROM runs) GROUP BY ALL
), f2 AS (
    SELECT lang, w1, w2, count(*) AS f
    FROM (SELECT lang, unnest(w[:-2]) AS w1, unnest(w[2:]) AS w2 FROM runs WHERE len(w) >= 2) GROUP BY ALL
), f3 AS (
    SELECT lang, w1, w2, w3, count(*) AS f
    FROM (SELECT lang, unnest(w[:-3]) AS w1, unnest(w[2:-2]) AS w2, unnest(w[3:]) AS w3 FROM runs WHERE len(w) >= 3) GROUP BY ALL
), cuts AS (
    SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, 1 AS k, x.f AS l, y.f AS r
    FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w2
    WHERE p.f >= 10 AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = p.lang AND t.w1 = p.w1 AND t.w2 = p.w2 AND t.f >= 10 AND 100 * t.f >= 50 * p.f)
        AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = p.lang AND t.w2 = p.w1 AND t.w3 = p.w2 AND t.f >= 10 AND 100 * t.f >= 50 * p.f)
    UNION ALL
    SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, p.f, 1, x.f, y.f
    FROM f3 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f2 y ON y.lang = p.lang AND y.w1 = p.w2 AND y.w2 = p.w3
    WHERE p.f >= 10
    UNION ALL
    SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, p.f, 2, x.f, y.f
    FROM f3 p JOIN f2 x ON x.lang = p.lang AND x.w1 = p.w1 AND x.w2 = p.w2 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w3
    WHERE p.f >= 10
), scored AS (
    SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(len(w))::BIGINT AS n FROM runs GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""
