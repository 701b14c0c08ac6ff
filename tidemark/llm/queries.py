"""The registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.ann import search
from tidemark.llm.bpe import decode, encode
from tidemark.llm.common import table
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.fim import fill_in_middle, restored
from tidemark.llm.html_text import extract_text
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import pack
from tidemark.llm.quality import quality_scores
from tidemark.llm.resample import resample
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.url_filter import judge_urls

#: The tokenizer vocabulary of the packing query, by its name in the public collection.
TOKENIZER = "word_bpe_49k.json"
#: The rank file of the byte-level encoding query, by its name there.
RANKS = "byte_bpe_multi_50k.tiktoken"
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = exact_dedup(docs)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.char_length("text").cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id % 20 = 0")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "source", "mix_tokens", "mix_epoch", "mix_order")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer_path(RANKS)
    out = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN), ranks)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = restored(fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text")
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_dedup, op2_quality, op3_packing, op4_html_text, op5_line_dedup, op6_url_filter, op7_nearest, op8_simhash, op9_mixing, op10_suffix_dedup, op11_byte_bpe, op12_fill_in_middle, op13_importance_resampling)
}

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op6_url_filter": f"""
        WITH rules(verdict, host, path) AS (VALUES {_RULES}),
        parts AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        urls AS (SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*', 0)) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
        fits AS (SELECT u.page_id, u.host, u.path, r.host || r.path AS rule, r.verdict FROM urls u LEFT JOIN rules r
                 ON (u.host = r.host OR u.host LIKE '%.' || r.host) AND starts_with(u.path, r.path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1""",
    "op12_fill_in_middle": r"""
        WITH tokens AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest,
                               regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS parts FROM documents),
        draws AS (SELECT doc_id, text, parts, len(parts)::BIGINT AS n, ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
                         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4 FROM tokens),
        cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                             WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM draws),
        pieces AS (SELECT doc_id, n, form, text, array_to_string(parts[1:a], '') AS p, array_to_string(parts[a + 1:b], '') AS m, array_to_string(parts[b + 1:], '') AS s FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256 FROM pieces""",
    # steps and crc_table make the byte table of CRC-32; hashed folds each distinct feature's bytes over it
    "op13_importance_resampling": r"""
        WITH RECURSIVE steps(b, c, k) AS (SELECT b, b, 0 FROM (SELECT unnest(range(256)) AS b) UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
        crc_table AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
        texts AS (SELECT 'd' AS side, doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents UNION ALL SELECT 'b', NULL, row_number() OVER (), coalesce(text, '') FROM benchmark),
        worded AS (SELECT side, doc_id, r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
        features AS (SELECT side, doc_id, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM worded),
        counted AS (SELECT side, doc_id, r, f, count(*) AS n FROM features GROUP BY ALL),
        hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
        hashed AS (SELECT f, xor(list_reduce(list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT), lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM hexed, crc_table),
        found AS (SELECT side, doc_id, r, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
        counts AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM found GROUP BY 1),
        gains AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counts) + 10000) / ((s + 1) * ((SELECT sum(t) FROM counts) + 10000))))::BIGINT AS gain FROM counts),
        weighed AS (SELECT w.doc_id, w.r, len(w.w)::BIGINT AS n_words, coalesce(sum(n), 0)::BIGINT AS n_features, coalesce(sum(n * gain), 0)::BIGINT AS weight FROM (SELECT * FROM worded WHERE side = 'd') w LEFT JOIN found f ON f.side = 'd' AND f.r = w.r LEFT JOIN gains g ON g.bucket = f.bucket GROUP BY 1, 2, 3),
        scored AS (SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighed),
        ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place, count(*) OVER () AS able FROM scored WHERE n_words >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * able // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (r)""",
}
