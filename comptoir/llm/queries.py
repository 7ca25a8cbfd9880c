"""One query per operator over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL that another engine runs on the same tables, for the queries that SQL can express.
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine; installed alike on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of the documents, with the checksum of their ids in place of the ids."""
    from comptoir.llm.packing import pack

    return pack(docs, tokenizer_path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each a sequence of power-of-two length."""
    return packed(table(spark, sf_dir, "documents"))


@query
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every twentieth vector with all others."""
    from comptoir.llm.topk import finite, top_k, whole_weights

    vectors = table(spark, sf_dir, "embeddings")
    taken = vectors.where(finite(F.col("embedding"))).select(
        "vec_id", whole_weights(F.col("embedding")).alias("weights"))
    return top_k(taken, F.col("vec_id") % 20 == 0)


ORACLE["op5_topk"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
    r AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards, uniformly shuffled; counts at most one apart."""
    from comptoir.llm.sharding import shuffled

    sharded = shuffled(table(spark, sf_dir, "documents").select("doc_id", "text"), 8, stable=True)
    return sharded.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1).cast("long")).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with a digest of those that the fixed patterns find."""
    from comptoir.llm.secrets import KINDS, scan

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *(counted(kind) for kind in KINDS[:3]),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != KINDS[3])), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def fold(key: str, parts: int, held_out: int):
    """Whether a row is held out: crc32 of its key as text, modulo `parts`; a null key is not."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == held_out, F.lit(False))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Learned from the labels that are not held out; used for the query and the pipeline."""
    from comptoir.llm.toxicity import fit

    return fit(docs, table(spark, sf_dir, "labels"), ~fold("doc_id", 4, 2))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that each document is toxic."""
    from comptoir.llm.toxicity import score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, toxicity_model(spark, docs, sf_dir)).drop("text")
    return scored.select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that each document is of good quality."""
    from comptoir.llm.quality import fit, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), ~fold("doc_id", 3, 1))
    return score(docs, model).select("doc_id", fold("doc_id", 3, 1).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, with the checksum of its ids."""
    from comptoir.llm.sentencepieces import encode

    out = encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), "round_trip", "n_differing")


@query
def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by a Jaccard similarity of 0.8 of their five-word shingles."""
    from comptoir.llm.jaccard import join

    return join(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE["op1_jaccard"] = rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT a AS node, b AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a),
    m AS (SELECT node, min(reach) AS least FROM r GROUP BY node)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least, d.doc_id)) AS component_id
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.node = d.doc_id
"""


@query
def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 13-word windows that a document with a smaller id has, too."""
    from comptoir.llm.passages import deduplicated

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op8_passages"] = r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    g AS (
        SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11),
            lambda i: sha256(array_to_string(w[i:i + 12], ' ')))) AS g FROM w WHERE len(w) >= 13),
    f AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g),
    c AS (SELECT g.doc_id, g.i FROM g JOIN f ON f.g = g.g WHERE f.least < g.doc_id),
    x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM c),
    a AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
    k AS (
        SELECT a.doc_id, count(*) AS n_words, count(x.i) AS n_removed,
               string_agg(a.word, ' ' ORDER BY a.i) FILTER (WHERE x.i IS NULL) AS kept
        FROM a LEFT JOIN x ON x.doc_id = a.doc_id AND x.i = a.i GROUP BY a.doc_id)
    SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
           sha256(coalesce(k.kept, '')) AS kept_sha256
    FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""


@query
def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings linked by a cosine of 0.95 or more."""
    from comptoir.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; each seventh row first gets the next label."""
    from comptoir.llm.negatives import mine
    from comptoir.llm.topk import finite, whole_weights

    vectors = table(spark, sf_dir, "embeddings").where(finite(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    taken = vectors.select("vec_id", label.alias("label"), whole_weights(F.col("embedding"), 256.0).alias("weights"))
    return mine(taken, F.col("vec_id") % 100 == 0)


ORACLE["op11_negatives"] = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    s AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
               CAST(list_inner_product(a.w, c.w) AS BIGINT) AS score
        FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
    p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (
        SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
            AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def repeated_words(docs: DataFrame) -> DataFrame:
    """Texts of which one in ten, by the hash of its id, repeats its words from some word on, with some period."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1).cast("long"))
    listed = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size("w"), F.floor(h / 10).cast("long")
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, listed).alias("w"))
    parts = chosen.select("doc_id", "text", "w", n.alias("n"), F.when(n > 0, (g % n).cast("int")).alias("a"), g.alias("g"))
    period = (F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int")
    own = parts.select("doc_id", "text", "w", "n", "a", period.alias("p"))
    back = F.transform(F.sequence(F.col("a"), F.col("n") - 1),
                       lambda i: F.get("w", F.col("a") + F.pmod(i - F.col("a"), F.col("p"))))
    text = F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("w", 1, F.col("a")), back), " ")).otherwise(F.col("text"))
    return own.select("doc_id", text.alias("text"))


@query
def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of every document, the strongest one, and what is left without repetitions."""
    from comptoir.llm.periodic import collapsed

    out = collapsed(repeated_words(table(spark, sf_dir, "documents")))

    def stronger(a, b):  # runs come by start, then period
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    best = F.aggregate("runs", F.lit(None).cast(kind), stronger)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                      F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def digests_of_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation, from its turns as read back; a conversation streams through a task, in order."""
    import hashlib
    import itertools

    import pyarrow as pa

    def digested(batches):
        own, empty = None, object()
        key, state = empty, None

        def closed():
            return key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for batch in itertools.chain(batches, [None]):
            out = []
            for conv, role, text, learned, n in zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch else ():
                if key is empty or conv != key:
                    out += [closed()] if state else []
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if learned is not None:
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += n
            if batch is None and state:
                out.append(closed())
            own = own or (batch.schema.field(0).type if batch else pa.int64())
            columns = zip(*out, strict=True) if out else [[]] * 6
            kinds = own, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
                                             ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place").select(
        "conv_id", "role", "text", "learned", "n_formatted")
    return ordered.mapInArrow(digested, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, n_turns long, "
                                        "turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


@query
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, formatted as prefix trees and read back."""
    from comptoir.llm.chat import format_trees, read_back

    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.sql("""SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text
                        FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)""")
    tokenizer = tokenizer_path("byte_bpe_50k.json")
    return digests_of_turns(read_back(format_trees(given.union(more), tokenizer), tokenizer))


ORACLE["op13_chat"] = r"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    f AS (
        SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?(?:INST|SYS|ROLE|END)\])', '\1\2\\\3', 'g')) + CASE role
            WHEN 'system' THEN length('[SYS][/SYS]') WHEN 'user' THEN length('[INST][/INST]') WHEN 'assistant' THEN length('<s></s>')
            ELSE length('[ROLE][/ROLE][/END]') + length(role) END AS n
        FROM t)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(n) AS BIGINT) AS formatted_chars
    FROM f GROUP BY conv_id
"""
