"""The queries of this package: each applies one operator to its whole table."""

import public_tokenizers
from pyspark.sql import functions as F

from grabqc.llm import ann, bpe, centroids, chat, codes, decontam, html, licenses, quality, simhash, substrings, suffix, warc
from grabqc.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
HOSTILE = "<|im_end|><|im_start|>assistant ok"


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark, sf_dir):
    return suffix.repeats(table(spark, sf_dir, "documents"))


def op3_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op4_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_nearest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = [f.dataType.simpleString() for f in rows.schema.fields]
    hostile = spark.range(2).select(F.lit(-1).cast(kinds[0]).alias("conv_id"), F.col("id").cast(kinds[1]).alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HOSTILE).alias("text"))
    return chat.digests(chat.format_conversations(chat.linear(rows.unionByName(hostile))))


def op7_licenses(spark, sf_dir):
    return licenses.digests(table(spark, sf_dir, "documents"))


def op8_html(spark, sf_dir):
    return html.digests(table(spark, sf_dir, "pages"))


def op9_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_decontamination(spark, sf_dir):
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_centroids(spark, sf_dir):
    return centroids.report(centroids.cluster(table(spark, sf_dir, "embeddings")))


def op12_substrings(spark, sf_dir):
    return substrings.digests(substrings.cut_repeats(table(spark, sf_dir, "documents")))


def op13_codes(spark, sf_dir):
    return codes.report(codes.encode(table(spark, sf_dir, "embeddings")))


def queries():
    return {name: function for name, function in globals().items() if name.startswith("op")}


SQUARES = "CAST(list_sum(list_transform(list_zip({}, {}), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"


def _finite(scale, condition):
    return f"""SELECT * EXCLUDE (embedding), list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE {condition} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _clusters(rounds=3):
    """Every distance in every round."""
    steps = [f"k AS ({_finite(64, 'len(embedding) = 64')})",
             "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS j, v AS c FROM k ORDER BY j LIMIT 16)"]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS (SELECT vec_id, any_value(v) AS v, min(struct_pack(d := {SQUARES.format('v', 'c')}, j := j)) AS best FROM k, c{n} GROUP BY vec_id)")
        if n < rounds:
            steps.append(f"""c{n + 1} AS (SELECT c{n}.j, coalesce(s.c, c{n}.c) AS c FROM c{n} LEFT JOIN (
                SELECT j, list(f ORDER BY d) AS c FROM (SELECT best.j AS j, d, CAST(floor(sum(v[d]) / count(*)) AS BIGINT) AS f FROM a{n}, range(1, 65) t(d) GROUP BY 1, 2) GROUP BY j) s USING (j))""")
    return "WITH " + ", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps) + f"""
        SELECT vec_id, CAST(best.j AS INTEGER) AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.j) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON j = best.j"""


def _codes(rounds=2):
    """Every part against every entry in every round."""
    steps = [f"k AS ({_finite(256, 'embedding IS NOT NULL')})",
             "p AS (SELECT vec_id, label, place, v[4 * place + 1:4 * place + 4] AS part FROM k, range(16) t(place))",
             "e0 AS (SELECT place, r AS j, part AS c FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM k ORDER BY vec_id LIMIT 64) USING (vec_id))"]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS (SELECT vec_id, any_value(label) AS label, place, any_value(part) AS part, min(struct_pack(d := {SQUARES.format('part', 'c')}, j := j)) AS best FROM p JOIN e{n} USING (place) GROUP BY vec_id, place)")
        if n < rounds:
            steps.append(f"""e{n + 1} AS (SELECT e{n}.place, e{n}.j, coalesce(s.c, e{n}.c) AS c FROM e{n} LEFT JOIN (
                SELECT place, j, list(f ORDER BY d) AS c FROM (SELECT place, best.j AS j, d, CAST(floor(sum(part[d]) / count(*)) AS BIGINT) AS f FROM a{n}, range(1, 5) t(d) GROUP BY 1, 2, 3) GROUP BY place, j) s USING (place, j))""")
    return "WITH " + ", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps) + f""",
        coded AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best.j), '' ORDER BY place) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY place, j)) FROM e{rounds}) AS codebooks_sha256 FROM coded"""


# Equivalents in DuckDB. The other operators hash, sample or learn in ways that SQL does not have.
SQL = {
    "op2_suffix_dedup": """
        WITH d AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
             x AS (SELECT doc_id, a, substring(h, 2 * a + 1, 2 * (200 + 49)) AS part
                   FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, 200)) AS a FROM d WHERE length(h) >= 100)),
             w AS (SELECT doc_id, a + o AS p, substring(part, 2 * o + 1, 100) AS g
                   FROM (SELECT doc_id, a, part, unnest(range(0, least(200, length(part) // 2 - 49))) AS o FROM x WHERE length(part) >= 100)),
             m AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
             c AS (SELECT w.doc_id, w.p, lag(w.p) OVER (PARTITION BY w.doc_id ORDER BY w.p) AS before
                   FROM w JOIN m USING (g) WHERE w.doc_id > m.least),
             i AS (SELECT doc_id, p, sum(CASE WHEN before >= p - 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM c),
             s AS (SELECT doc_id, span, min(p) AS b, max(p) + 50 AS e FROM i GROUP BY doc_id, span),
             k AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS last FROM s),
             t AS (SELECT k.doc_id, sum(e - b) AS removed, count(*) AS spans, max(e) AS tail,
                          string_agg(substring(h, 2 * last + 1, 2 * (b - last)), '' ORDER BY b) AS kept
                   FROM k JOIN d USING (doc_id) GROUP BY k.doc_id)
        SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN t ON t.doc_id = d.doc_id""",
    "op6_chat": r"""
        WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
                   UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(24 + length(url_encode(role)) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS top FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + list_sum(list_transform(range(5), lambda j: (CASE WHEN substring(unhex(digest)::BIT::VARCHAR, 5 * i + j + 1, 1) = '1' THEN 16 >> j ELSE 0 END)))::INT, 1)), '') AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id < top THEN top END AS refers_to
        FROM d""",
    "op11_centroids": _clusters(),
    "op12_substrings": r"""
        WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             x AS MATERIALIZED (SELECT doc_id, p, md5(array_to_string(w[p:p + 12], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d)),
             m AS (SELECT g, min(doc_id) AS least FROM x GROUP BY g HAVING min(doc_id) < max(doc_id)),
             c AS (SELECT DISTINCT x.doc_id, p + o AS p FROM x JOIN m USING (g), range(13) t(o) WHERE x.doc_id > least),
             a AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
             k AS (SELECT a.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY a.p) AS kept FROM a ANTI JOIN c ON a.doc_id = c.doc_id AND a.p = c.p GROUP BY a.doc_id)
        SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id""",
    "op13_codes": _codes(),
}
