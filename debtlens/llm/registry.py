"""The registered queries of this package and the SQL they must equal, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from debtlens.llm import (
    bpe_count,
    exact_dedup,
    html_text,
    huffman,
    lexical,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    quality,
    rules,
    variants,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLE_SQL[run.__name__] = sql.strip()
        return run

    return register


@query(
    """
    WITH texts AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    ), kept AS (
        SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY t
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM texts JOIN kept USING (t)
    """
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
            ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: list_slice(w, i, i + 4))) END AS s
        FROM texts
    ), shingles AS (
        SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
    ), links AS (
        SELECT a.doc_id AS one, b.doc_id AS other FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ), reached AS (
        SELECT doc_id, doc_id AS id FROM sets
        UNION
        SELECT doc_id, other FROM reached JOIN links ON one = id
    )
    SELECT doc_id, any_value(len(s)) AS n_shingles, min(id) AS component_id, doc_id = min(id) AS kept
    FROM sets JOIN reached USING (doc_id) GROUP BY doc_id
    """
)
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(table(spark, sf_dir, "documents"), percent=85)


@query()
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@query()
def op4_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.report(table(spark, sf_dir, "documents"))


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.report(table(spark, sf_dir, "documents"))


@query()
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query(
    r"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
    ), cut AS (
        SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
            list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM texts
    ), windows AS (
        SELECT r, i, list_slice(words, i, i + 4) AS w
        FROM (SELECT r, words, unnest(generate_series(1, len(words) - 4)) AS i FROM cut WHERE len(words) >= 5)
    ), repeated AS (
        SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
    ), covered AS (
        SELECT r, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY r
    ), base AS (
        SELECT doc_id, t, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
            len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
        FROM cut LEFT JOIN covered USING (r)
    ), judged AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed
        AND 100 * n_symbols <= 20 * n_words
        AND NOT (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)
        AND word_chars BETWEEN 2 * n_words AND 20 * n_words
        AND 100 * len(regexp_extract_all(t, '\p{Lu}')) <= 40 * word_chars
        AND 100 * len(regexp_extract_all(t, '!')) <= 50 * n_words
        AND 100 * len(regexp_extract_all(t, '\p{L}')) >= 50 * word_chars AS kept
    FROM judged
    """
)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report(table(spark, sf_dir, "documents"))


@query()
def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


@query()
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH cut AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), docs AS (
        SELECT r, doc_id, len(w) AS n, w FROM cut WHERE len(w) > 0
    ), whole AS (
        SELECT count(*) AS nd, sum(n)::BIGINT AS total FROM docs
    ), lists AS (
        SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t
    ), weights AS (
        SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM lists, whole GROUP BY t, nd
    ), items AS (
        SELECT row_number() OVER () AS q, item_id, unnest(list_distinct(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t
        FROM benchmark
    ), scored AS (
        SELECT q, item_id, r, doc_id,
            sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // total))))::BIGINT AS score
        FROM items JOIN lists USING (t) JOIN weights USING (t) JOIN docs USING (r), whole
        GROUP BY q, item_id, r, doc_id
    )
    SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10
    """
)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _templates_sql() -> str:
    """The fixed templates as rows (family, label, width, words), in the operator's widths."""
    return ",\n            ".join(
        f"('{t.family}', '{t.label}', {t.width}, string_split('{' '.join(t.words)}', ' '))" for t in licenses.templates()
    )


@query(
    r"""
    WITH templates(family, label, width, w) AS (
        VALUES
            {templates}
    ), template_words AS (
        SELECT family, label, width, unnest(list_distinct(w)) AS t, len(list_distinct(w)) AS size,
            CASE WHEN len(list_distinct(w)) < 12 THEN len(list_distinct(w)) ELSE (80 * len(list_distinct(w)) + 99) // 100 END AS needed
        FROM templates
    ), phrases(p, label) AS (
        VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')
    ), docs AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), words AS (
        SELECT r, len(w) AS n, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS i FROM docs
    ), places AS (
        SELECT r, i, phrases.label FROM words JOIN docs USING (r) JOIN phrases ON t = p[1] AND docs.w[i + 1 : i + len(p)] = p
    ), base AS (
        SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY r
    ), windows AS (
        SELECT DISTINCT r, width, unnest([i // (width // 2), i // (width // 2) - 1]) AS k, t, greatest(1, (n + width // 2 - 1) // (width // 2) - 1) AS many
        FROM words JOIN (SELECT DISTINCT width, t FROM template_words) USING (t)
    ), met AS (
        SELECT r, family, label, size, count(*) AS common
        FROM windows JOIN template_words USING (width, t) WHERE k BETWEEN 0 AND many - 1
        GROUP BY r, width, k, family, label, size, needed HAVING count(*) >= needed
    ), best AS (
        SELECT r, label, common / size AS containment,
            rank() OVER (PARTITION BY r, family ORDER BY common / size DESC, size DESC) AS place
        FROM met
    ), own AS (
        SELECT r, list(DISTINCT label) FILTER (place = 1) AS labels, max(containment) AS score FROM best GROUP BY r
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
        array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
        array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') AS labels,
        CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0::DOUBLE) END AS score
    FROM docs LEFT JOIN base USING (r) LEFT JOIN own USING (r)
    """.replace("{templates}", _templates_sql())
)
def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents
    ), distinct_runs AS (
        SELECT doc_id, run, count(*) AS many,
            list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: unicode(c)::BIGINT) AS points
        FROM runs WHERE len(run) >= 6 GROUP BY doc_id, run
    ), bytes AS (
        -- UTF-8: what is not ASCII here takes two bytes.
        SELECT doc_id, run, many, flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + p // 64, 128 + p % 64] END)) AS b
        FROM distinct_runs
    ), numbered AS (
        -- CRC-32, bit by bit: the register starts and ends inverted.
        SELECT run, many, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x:
            list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, i: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END))) AS h
        FROM bytes
    ), shortened AS (
        SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % len(run))::BIGINT) || substr(run, (h % len(run))::BIGINT + 2) ELSE run END AS word, many
        FROM numbered
    ), words AS (
        SELECT word, sum(many)::BIGINT AS n FROM shortened WHERE len(word) >= 6 GROUP BY word HAVING sum(many) >= 5
    ), without AS (
        SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, n, unnest(generate_series(1, len(word))) AS i FROM words)
    ), pairs AS (
        SELECT DISTINCT a.word AS word, b.word AS other, b.n AS other_n
        FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION
        SELECT DISTINCT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
        UNION
        SELECT DISTINCT a.rest, a.word, a.n FROM without a JOIN words b ON a.rest = b.word
    ), best AS (
        SELECT word, count(*) AS n_near, max(other_n) AS most,
            first(other ORDER BY other_n DESC, encode(other)) AS other
        FROM pairs GROUP BY word
    ), forms AS (
        SELECT words.word, n, coalesce(n_near, 0) AS n_near,
            CASE WHEN most >= 5 * n THEN other END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n
        FROM words LEFT JOIN best USING (word)
    ), steps AS (
        SELECT word, word AS root FROM forms
        UNION ALL
        SELECT steps.word, forms.form FROM steps JOIN forms ON steps.root = forms.word WHERE forms.form IS NOT NULL
    ), last AS (
        SELECT steps.word, root FROM steps JOIN forms ON root = forms.word WHERE forms.form IS NULL
    )
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN last USING (word)
    """
)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.report(table(spark, sf_dir, "documents"))
