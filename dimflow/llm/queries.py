"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm import (
    bpe,
    embeddings,
    langid,
    negatives,
    packing,
    preferences,
    quality,
    simhash,
    suffixes,
    token_counts,
    token_files,
    urls,
    vector_codes,
)
from dimflow.llm.storage import Stored, new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, length=1024, end_id=0)
    return pieces.select(
        F.col("key").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query()
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Stored(spark) as held:
        found = suffixes.remove_repeats(docs, held, span=200).select(
            F.col("row.doc_id").alias("doc_id"),
            "n_bytes",
            "n_removed",
            F.size("spans").cast("bigint").alias("n_spans"),
            F.sha2("kept", 256).alias("kept_sha256"),
        )
        return held.keep(found, last=True)


@query(
    r"""
    WITH turns AS (
        SELECT row_number() OVER () AS r, conv_id, turn, role, text FROM conversations
    ), grouped AS (
        SELECT conv_id, list(struct_pack(r := role, t := text)
            ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS l
        FROM turns GROUP BY conv_id, CASE WHEN conv_id IS NULL THEN r END
    ), said AS (
        SELECT *, list_filter(range(1, len(l) + 1), lambda i: coalesce(l[i].r, '') = 'assistant') AS s
        FROM grouped
    ), changes AS (
        SELECT conv_id, l, s[-1] AS changed, s[-2] AS taken FROM said WHERE len(s) > 0
        UNION ALL SELECT conv_id, l, s[1], s[2] FROM said WHERE len(s) > 1
        UNION ALL SELECT conv_id, l, NULL, NULL FROM said WHERE len(s) = 0
    ), pairs AS (
        SELECT conv_id, changed, l AS c, list_transform(range(1, len(l) + 1), lambda i:
            CASE WHEN i = changed THEN struct_pack(r := l[i].r, t := coalesce(l[taken].t, ''))
                ELSE l[i] END) AS j
        FROM changes
    ), common AS (
        SELECT *, coalesce(list_position(list_transform(range(1, len(c) + 1),
            lambda i: c[i] IS NOT DISTINCT FROM j[i]), false) - 1, len(c)) AS n FROM pairs
    ), heads AS (
        SELECT conv_id, changed, n,
            list_transform(c, lambda x: '<|' || replace(coalesce(x.r, ''), '<|', '< |') || '|>' || chr(10)) AS ch,
            list_transform(c, lambda x: replace(coalesce(x.t, ''), '<|', '< |') || '<|end|>' || chr(10)) AS cb,
            list_transform(j, lambda x: '<|' || replace(coalesce(x.r, ''), '<|', '< |') || '|>' || chr(10)) AS jh,
            list_transform(j, lambda x: replace(coalesce(x.t, ''), '<|', '< |') || '<|end|>' || chr(10)) AS jb,
            list_transform(c, lambda x: coalesce(x.r, '') = 'assistant') AS ca,
            list_transform(j, lambda x: coalesce(x.r, '') = 'assistant') AS ja
        FROM common
    )
    SELECT conv_id, changed::INTEGER AS changed_turn, n::INTEGER AS common_turns,
        coalesce(list_aggregate(list_transform(range(1, n + 1), lambda i: ch[i] || cb[i]), 'string_agg', ''), '') AS prompt,
        coalesce(list_aggregate(list_transform(range(n + 1, len(ch) + 1), lambda i: ch[i] || cb[i]), 'string_agg', ''), '') AS chosen,
        coalesce(list_aggregate(list_transform(range(n + 1, len(jh) + 1), lambda i: jh[i] || jb[i]), 'string_agg', ''), '') AS rejected,
        coalesce(list_aggregate(list_transform(range(n + 1, len(ch) + 1),
            lambda i: length(ch[i]) || ':0 ' || length(cb[i]) || CASE WHEN ca[i] THEN ':1' ELSE ':0' END), 'string_agg', ' '), '') AS chosen_mask,
        coalesce(list_aggregate(list_transform(range(n + 1, len(jh) + 1),
            lambda i: length(jh[i]) || ':0 ' || length(jb[i]) || CASE WHEN ja[i] THEN ':1' ELSE ':0' END), 'string_agg', ' '), '') AS rejected_mask
    FROM heads
    """
)
def op3_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preferences.reply_pairs(table(spark, sf_dir, "conversations"))
    found = preferences.format_pairs(pairs, "key", "chosen", "rejected", carried=("changed",))

    def text(column: str):
        return F.array_join(F.transform(column, lambda s: s["text"]), "")

    def mask(column: str):
        """Lengths of the segments with 1 for those that are trained on."""
        marks = F.transform(
            column, lambda s: F.concat_ws(":", F.length(s["text"]), s["train"].cast("int"))
        )
        return F.array_join(marks, " ")

    return found.select(
        F.col("key").alias("conv_id"),
        F.col("changed").alias("changed_turn"),
        F.col("common").alias("common_turns"),
        "prompt",
        text("chosen").alias("chosen"),
        text("rejected").alias("rejected"),
        mask("chosen").alias("chosen_mask"),
        mask("rejected").alias("rejected_mask"),
    )


@query(
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host,
            coalesce(text, '') AS text FROM documents
    ), w AS (
        SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
    ), windows AS (
        SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
        FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
    ), twice AS (
        SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows)
        WHERE n > 1
    ), repeated AS (
        SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) t(k) GROUP BY r
    ), split AS (
        SELECT r, host, text, doc_id, unnest(string_split(text, chr(10))) AS line FROM d
    ), lines AS (
        SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
            translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
        FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    ), dups AS (
        SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r
    ), frequent AS (
        SELECT host, norm, arg_min(text, doc_id) AS first_text
        FROM (SELECT host, norm, text, min(doc_id) AS doc_id FROM lines GROUP BY ALL)
        JOIN (SELECT host, count(DISTINCT text) AS docs FROM d GROUP BY host) USING (host)
        GROUP BY host, norm
        HAVING count(*) > 20 AND (count(*) * 100 > any_value(docs) OR count(*) > 10000)
    ), gone AS (
        SELECT r, sum(n) AS n FROM lines JOIN frequent USING (host, norm)
        WHERE text <> first_text GROUP BY r
    ), base AS (
        SELECT d.doc_id, len(words)::BIGINT AS n_words,
            length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
            coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
            coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
            coalesce(gone.n, 0)::BIGINT AS removed_words
        FROM d JOIN w USING (r) LEFT JOIN dups USING (r) LEFT JOIN repeated USING (r)
        LEFT JOIN gone USING (r)
    )
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
            AND 100 * (n_words - removed_words) >= 30 * n_words AS kept
    FROM base
    """
)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Stored(spark) as held:
        verdicts = quality.judge(table(spark, sf_dir, "documents"), held).select(
            F.col("key").alias("doc_id"),
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "removed_words",
            "base_failed",
            "kept",
        )
        return held.keep(verdicts, last=True)


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out("doc_id")), "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select(
        F.col("key").alias("doc_id"), langid.held_out("key").alias("held_out"), "lang_pred", "score"
    )


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Stored(spark) as held:
        found = simhash.near_duplicates(
            table(spark, sf_dir, "documents"), held, shingle=3, radius=3
        )
        return held.keep(
            found.select(
                F.col("key").alias("doc_id"),
                F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
                F.col("component").alias("component_id"),
            ),
            last=True,
        )


URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query(urls.judge_sql(URL_RULES))
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Stored(spark) as held:
        found = urls.judge(table(spark, sf_dir, "pages"), URL_RULES, held)
        return held.keep(found.withColumnRenamed("key", "page_id"), last=True)


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(table(spark, sf_dir, "documents"), WORD_BPE)
    return coded.select(
        F.col("key").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, WORD_BPE, end_id=2)
    return token_files.read_token_files(spark, folder).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query()
def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Stored(spark) as held:
        found = embeddings.near_duplicates(
            table(spark, sf_dir, "embeddings"), held, threshold=0.95
        )
        return held.keep(
            found.select(
                F.col("key").alias("vec_id"),
                "n_links",
                F.col("component").alias("component_id"),
                F.col("key").eqNullSafe(F.col("component")).alias("kept"),
            ),
            last=True,
        )


@query(
    """
    WITH taking AS (
        SELECT row_number() OVER () AS r, vec_id,
            CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.l = b.l AS same,
            list_inner_product(a.v, b.v)::BIGINT AS score
        FROM taking a JOIN taking b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)
    ), positives AS (
        SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) AS place
        FROM scored WHERE same QUALIFY place <= 5
    )
    SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (
            PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id, n.r
        )::INTEGER AS rank, n.vec_id AS negative_id, p.score AS positive_score,
        n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
        AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
    QUALIFY rank <= 10
    """
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("vec_id")
    moved = F.when(key % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    with Stored(spark) as held:
        found = negatives.mine(
            table(spark, sf_dir, "embeddings"), held, is_anchor=key % 100 == 0, label=moved,
            scale=256, positives=5, negatives=10, low=30, high=90,
        )
        names = {c: f"{c}_id" for c in ("anchor", "positive", "negative")}
        return held.keep(found.withColumnsRenamed(names), last=True)


@query(vector_codes.compress_sql(rounds=4))
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Stored(spark) as held:
        codes, books = vector_codes.compress(
            table(spark, sf_dir, "embeddings"), held, scale=1024, parts=4, entries=256, rounds=4
        )
        found = vector_codes.label_errors(codes).select(
            F.col("key").alias("vec_id"),
            "code",
            "error",
            "label_error",
            F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"),
        )
        return held.keep(found, last=True)


@query()
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache of this query is new in each run, so that it counts every text."""
    with Stored(spark) as held:
        found = token_counts.count_tokens(
            table(spark, sf_dir, "documents"), BYTE_BPE, held.folder(), held, limit=1024
        )
        return held.keep(
            found.select(F.col("key").alias("doc_id"), "n_bytes", "n_tokens", "over_limit"),
            last=True,
        )
