"""Queries over the text tables, and SQL with the same result where SQL has it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens import scratch
from loanlens.llm import (
    chat,
    decontaminate,
    forest,
    grammar,
    language,
    mixing,
    packing,
    phrases,
    runs,
    set_join,
    toxicity,
    urls,
    warc,
)
from loanlens.llm.store import Store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return forest.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned outside a held-out third."""
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


def op3_secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All secrets of every document, by fixed patterns and by learned formats."""
    docs = table(spark, sf_dir, "documents")
    return grammar.find(docs, grammar.train(docs))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix's decision on every document."""
    sized = mixing.with_sizes(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "draw")
    mixed = mixing.mix(scratch.materialise(sized))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark passage, with the item and the overlap."""
    return decontaminate.find_overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op6_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies each document belongs to: 3 words, Jaccard 0.9."""
    return set_join.link_groups(table(spark, sf_dir, "documents"), size=3, numer=90, denom=100)


def op7_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's messages linked, ordered, validated, as canonical JSON."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op8_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to bundles and read back; the bundles go once they are read."""
    store = Store(spark)
    folder = scratch.new_folder(spark, "warc")
    index = store.put("index", warc.write_bundles(table(spark, sf_dir, "pages"), folder))
    records = store.put("records", warc.read_bundles(index))
    scratch.remove(spark, folder)
    store.drop("index")
    return records


def op9_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document, learned outside a held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held = docs.select("doc_id", "text", toxicity.held_out(F.col("doc_id")).alias("held_out"))
    return toxicity.score(held, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_url_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return urls.judge(table(spark, sf_dir, "pages"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts of a tenth, by a hash of the id, repeating from a word on.

    With h the CRC-32 of the decimal id and g = h div 10, a text of n words with h
    divisible by 10 repeats its 1 + (n - a) div (3 + g % 8) words from word a = g % n.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    repeated = F.expr(r"""
        transform(transform(transform(array(
            regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)),
            w -> named_struct('w', w, 'a', if(size(w) > 0, int(_g % size(w)), 0))),
            s -> named_struct('w', s.w, 'a', s.a, 'p', int(1 + (size(s.w) - s.a) div (3 + _g % 8)))),
            s -> array_join(transform(s.w, (x, i) -> if(i < s.a, x, s.w[s.a + (i - s.a) % s.p])), ' '))[0]
    """)
    hashed = docs.select("doc_id", "text", h.alias("_h"), F.floor(h / 10).alias("_g"))
    text = F.when(F.col("_h") % 10 == 0, repeated).otherwise(F.col("text"))
    return hashed.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periodic runs of every document, the strongest, and the text without repeats."""
    found = runs.find_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    stronger = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda held, run: F.when(run["length"] * held["period"] > held["length"] * run["period"], run).otherwise(held),
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.transform(line, lambda text: F.concat(text, F.lit("\n")))
    return found.withColumn("best", stronger).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_square_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of 1024, with a digest of each piece."""
    pieces = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hash_forest": op1_hash_forest,
    "op2_language_id": op2_language_id,
    "op3_secret_grammar": op3_secret_grammar,
    "op4_source_mix": op4_source_mix,
    "op5_spaced_seeds": op5_spaced_seeds,
    "op6_set_join": op6_set_join,
    "op7_tool_chat": op7_tool_chat,
    "op8_seekable_warc": op8_seekable_warc,
    "op9_toxicity_pu": op9_toxicity_pu,
    "op10_url_segments": op10_url_segments,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_square_packing": op12_square_packing,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op13_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang
), grams AS (
    SELECT lang, k, phrase, count(*) AS a
    FROM (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
          FROM split, (VALUES (1), (2), (3)) AS sizes(k))
    GROUP BY lang, k, phrase HAVING count(*) >= 10
), candidates AS (
    SELECT *, str_split(phrase, ' ') AS parts FROM grams WHERE k > 1
), cuts AS (
    SELECT lang, k, phrase, a, cut, array_to_string(parts[1:cut], ' ') AS head, array_to_string(parts[cut + 1:], ' ') AS tail
    FROM candidates, (VALUES (1), (2)) AS places(cut) WHERE cut < k
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.a AS l, y.a AS r,
           ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
    FROM cuts c JOIN grams x ON c.lang = x.lang AND c.head = x.phrase JOIN grams y ON c.lang = y.lang AND c.tail = y.phrase
), weakest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored
), longer AS (
    SELECT lang, part, max(a) AS a
    FROM (SELECT lang, a, unnest([array_to_string(parts[1:2], ' '), array_to_string(parts[2:3], ' ')]) AS part
          FROM candidates WHERE k = 3)
    GROUP BY lang, part
), kept AS (
    SELECT w.* FROM weakest w LEFT JOIN longer g ON w.lang = g.lang AND w.phrase = g.part
    WHERE w.place = 1 AND (g.a IS NULL OR 100 * g.a < 50 * w.a)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score FROM ranked k JOIN totals t ON k.lang = t.lang WHERE k.rank <= 2000
""",
    "op11_periodic_runs": r"""
WITH RECURSIVE bits AS (
    SELECT DISTINCT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS c FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT doc_id, s, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END
    FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(c, ascii(substr(s, k // 8 + 1, 1))::BIGINT) ELSE c END AS x
          FROM bits WHERE k < 8 * length(s))
), hashes AS (
    SELECT doc_id, xor(c, 4294967295::BIGINT) AS h FROM bits WHERE k = 8 * length(s)
), split AS (
    SELECT d.doc_id, coalesce(h.h, 1) AS h, coalesce(h.h, 1) // 10 AS g,
           coalesce(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents d LEFT JOIN hashes h ON d.doc_id = h.doc_id
), placed AS (
    SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN g % len(w) ELSE 0 END AS a FROM split
), texts AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN [w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END] FOR i IN range(n)]
        ELSE w END AS w
    FROM placed
), places AS (
    SELECT doc_id, n, w, unnest(range(n - 15)) AS i FROM texts WHERE n >= 24
), grams AS (
    SELECT doc_id, n, i, array_to_string(w[i + 1:i + 16], ' ') AS gram FROM places
), matched AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i
    FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i AND 3 * (y.i - x.i) <= x.n
), islands AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM matched
), stretches AS (
    SELECT doc_id, q, min(i) AS start, max(i) + 16 + q - min(i) AS length FROM islands GROUP BY doc_id, q, island
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches
    WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
           first(struct_pack(s := start, l := length, p := period) ORDER BY length / period DESC, start, period) AS best,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
), words AS (
    SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM texts WHERE doc_id IN (SELECT doc_id FROM runs)
), collapsed AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words
    WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = words.doc_id
                      AND words.i >= r.start + r.period AND words.i < r.start + r.length)
    GROUP BY doc_id
)
SELECT t.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, l.best.s::BIGINT AS start, l.best.l::BIGINT AS length,
       l.best.p::BIGINT AS period, (1000 * l.best.l // l.best.p)::BIGINT AS exponent_milli,
       sha256(coalesce(l.lines, '')) AS runs_sha256,
       sha256(CASE WHEN l.doc_id IS NULL THEN array_to_string(t.w, ' ') ELSE c.text END) AS collapsed_sha256
FROM texts t LEFT JOIN listed l ON t.doc_id = l.doc_id LEFT JOIN collapsed c ON t.doc_id = c.doc_id
""",
    "op7_tool_chat": r"""
WITH events AS (
    SELECT conv_id, turn, role, text,
           CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
           CASE role WHEN 'user' THEN 'turn:' || turn WHEN 'assistant' THEN 'turn:' || (turn - 1) END AS call_id
    FROM conversations
), calls AS (
    SELECT conv_id, call_id, min(turn) AS call_turn FROM events WHERE kind = 'call' GROUP BY conv_id, call_id
), answered AS (
    SELECT DISTINCT conv_id, call_id FROM events WHERE kind = 'result'
), linked AS (
    SELECT e.*, c.call_turn,
           CASE e.kind WHEN 'call' THEN a.call_id IS NOT NULL WHEN 'result' THEN c.call_id IS NOT NULL ELSE false END AS linked,
           CASE WHEN e.kind = 'result' AND c.call_id IS NOT NULL THEN 1 ELSE 0 END AS level
    FROM events e
    LEFT JOIN calls c ON e.conv_id = c.conv_id AND e.call_id = c.call_id
    LEFT JOIN answered a ON e.conv_id = a.conv_id AND e.call_id = a.call_id
)
SELECT conv_id, turn, kind, call_id, linked, level,
       kind <> 'call' OR text IS NOT NULL AS valid,
       CASE WHEN kind = 'call' AND text IS NULL THEN 'text is missing' ELSE '' END AS problems,
       row_number() OVER (PARTITION BY conv_id ORDER BY
           CASE WHEN kind = 'result' THEN coalesce(call_turn, turn) ELSE turn END, level, turn, kind, call_id) - 1 AS position,
       CASE kind
           WHEN 'call' THEN '{"arguments":{' || coalesce('"text":' || to_json(text)::VARCHAR, '') || '},"call_id":"' || call_id
                            || '","kind":"call","name":"reply","role":"' || role || '","turn":' || turn || '}'
           WHEN 'result' THEN '{"call_id":"' || call_id || '","content":' || coalesce(to_json(text)::VARCHAR, 'null')
                            || ',"kind":"result","role":"' || role || '","turn":' || turn || '}'
           ELSE '{"content":' || coalesce(to_json(text)::VARCHAR, 'null')
                            || ',"kind":"message","role":"' || role || '","turn":' || turn || '}' END AS json
FROM linked
""",
    "op8_seekable_warc": """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), kept AS (
    SELECT *, CASE WHEN payload_bytes >= 1000
                   THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS keeper
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM kept
""",
    "op6_set_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
                        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s
    FROM words
), classes AS (
    SELECT list_sort(s) AS s, min(doc_id) AS c FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), items AS (
    SELECT c, len(s) AS n, unnest(s) AS t FROM classes
), pairs AS (
    SELECT x.c AS a, y.c AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS o
    FROM items x JOIN items y ON x.t = y.t AND x.c < y.c
        AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
    GROUP BY x.c, y.c
), links AS (
    SELECT a, b FROM pairs WHERE 100 * o >= 90 * (n + m - o)
), reach AS (
    SELECT c AS node, c AS goal FROM classes
    UNION
    SELECT r.node, l.far FROM reach r
    JOIN (SELECT a AS near, b AS far FROM links UNION ALL SELECT b, a FROM links) l ON r.goal = l.near
), least AS (
    SELECT node, min(goal) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes k ON list_sort(d.s) = k.s LEFT JOIN least l ON k.c = l.node
""",
    "op4_source_mix": r"""
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(source, '') || ':' || coalesce(text, '')), 1, 8))
             ::UBIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
    FROM sized GROUP BY source
), quotients AS (
    SELECT *, source_size * 2.0::DOUBLE AS most,
           ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
              - ((sum(source_size) OVER rising)::DOUBLE * 2.0::DOUBLE - source_size * 2.0::DOUBLE))
             / sum(weight) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS quotient
    FROM sources
    WINDOW rising AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), targets AS (
    SELECT source, source_size, least(most, max(quotient) OVER () * weight) AS target FROM quotients
), rated AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
           CASE WHEN t.source_size = 0 THEN 0.0::DOUBLE ELSE t.target / t.source_size END AS rate, d.u
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
""",
}
