"""The registered queries of the training-data operators, ``opN_<name>``, and their DuckDB oracles.

Each query applies its operator with production parameters to its whole table and returns the full
result; digests the contract asks for are derived here from the operator's real outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm import bpe, chat, coder, embeddings, iblt, mixing, neardup, negatives, packing, quality, runs, substring, warc
from loadcast.llm.scratch import folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file (found through the installed package, never copied)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed text: words of a text, A-Z lowered or unchanged, as a DuckDB list.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP4_ORACLE = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(_LOWERED)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.c AS component_id, s.doc_id = c.c AS kept
FROM sets s JOIN comp c ON s.doc_id = c.x"""


@register("op1_iblt_fingerprints")
def op1_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invertible sketches of every text and its edited version, and likeness by peeling."""
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


@register("op2_context_mixing_coder")
def op2_context_mixing_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION. Ids of byte_bpe_50k.json written as range-coded blocks and read back."""
    place = folder(spark)
    coder.write(table(spark, sf_dir, "documents"), place, tokenizer_file("byte_bpe_50k.json"), end_id=0)
    return coder.read(spark, place).select("doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@register("op3_bradley_terry_quality")
def op3_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION. Pairwise ranking learned outside the held-out third, every document scored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@register("op4_minhash_near_dedup", _OP4_ORACLE)
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION. Tensored-banding near-duplicate components: 3-word shingles, Jaccard >= 0.85."""
    out = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


_OP9_ORACLE = f"""
WITH words AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM words WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS lo FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM windows JOIN firsts USING (h) WHERE doc_id > lo),
gone_list AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(w) AS n, CASE WHEN g IS NULL THEN w
    ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(g, i)), lambda i: w[i]) END AS k
  FROM words w LEFT JOIN gone_list USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(k) AS BIGINT) AS n_removed,
  sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept"""


@register("op9_fixed_block_substring_dedup", _OP9_ORACLE)
def op9_fixed_block_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION. Words covered by 50-word windows that a smaller document also has are removed."""
    out = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@register("op6_bpe_automaton")
def op6_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge automaton of word_bpe_49k.json over whole documents, and back."""
    path = tokenizer_file("word_bpe_49k.json")
    out = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded="decoded")
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op5_content_addressed_warc")
def op5_content_addressed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION. Pages archived with payloads stored once, read back from the rebuilt records."""
    place = folder(spark)
    warc.write(table(spark, sf_dir, "pages"), place)
    return warc.parse(warc.records(spark, place)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Fixed values of the mixing query: weights by level, share of all tokens, passes, seed.
MIX_WEIGHTS = {"domain": {"0": 1.0, "1": 2.0, "2": 3.0, "3": 1.5}, "lang": {"en": 1.0, "de": 2.0, "fr": 2.0, "es": 3.0},
               "source": {"src0": 0.5}}
MIX = {"fraction": 0.5, "max_epochs": 3, "seed": 7}


def source_domain():
    """Domain of a source in the test tables: its number modulo four."""
    return F.pmod(F.regexp_extract("source", r"(\d+)$", 1).try_cast("int"), F.lit(4)).cast("string")


def _mix_level(name: str, above: str, keys: list[str], weight: str) -> str:
    """Budgets of one level of the tree in SQL: closed-form water filling per parent."""
    up, cols = keys[:-1], ", ".join(keys)
    on = " AND ".join(f"c.{k} IS NOT DISTINCT FROM p.{k}" for k in up) or "true"
    part = f"PARTITION BY {', '.join(up)}" if up else ""
    return f"""
{name}_c AS (SELECT {cols}, sum(supply) * {MIX['max_epochs']}::DOUBLE AS capacity, {weight} AS weight FROM supply GROUP BY {cols}),
{name}_r AS (SELECT {', '.join('c.' + k for k in keys)}, capacity, weight, p.budget AS parent, capacity / weight AS ratio
  FROM {name}_c c JOIN {above} p ON {on}),
{name}_l AS (SELECT *, (parent - coalesce(sum(capacity) OVER ({part} ORDER BY ratio, {cols} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER ({part} ORDER BY ratio, {cols} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM {name}_r),
{name}_w AS (SELECT *, max(CASE WHEN ratio >= level THEN level END) OVER ({part}) AS water FROM {name}_l),
{name} AS (SELECT {cols}, CASE WHEN water IS NULL THEN capacity ELSE least(capacity, weight * water) END AS budget FROM {name}_w)"""


def _case(level: str) -> str:
    whens = " ".join(f"WHEN {level} = '{k}' THEN {v!r}::DOUBLE" for k, v in MIX_WEIGHTS[level].items())
    return f"(CASE {whens} ELSE 1.0::DOUBLE END)"


_OP7_ORACLE = rf"""
WITH base AS (SELECT doc_id, lang, source, text, CAST(CAST(regexp_extract(source, '(\d+)$', 1) AS INT) % 4 AS VARCHAR) AS domain,
  CAST(len({_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS n_tokens FROM documents),
supply AS (SELECT domain, lang, source, sum(n_tokens)::DOUBLE AS supply FROM base GROUP BY ALL),
root AS (SELECT least(sum(supply) * {MIX['fraction']}::DOUBLE, sum(supply) * {MIX['max_epochs']}::DOUBLE) AS budget FROM supply),
{_mix_level("l1", "root", ["domain"], _case("domain"))},
{_mix_level("l2", "l1", ["domain", "lang"], _case("lang"))},
{_mix_level("l3", "l2", ["domain", "lang", "source"], _case("source"))},
leaf AS (SELECT domain, lang, source, CAST(floor(budget + 1e-6) AS BIGINT) AS target, CAST(supply AS BIGINT) AS supply
  FROM l3 JOIN supply USING (domain, lang, source)),
placed AS (SELECT b.*, target, target // supply AS epochs, target % supply AS rest FROM base b JOIN leaf USING (domain, lang, source)),
ordered AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
  ORDER BY md5(concat('{MIX['seed']}', ':', epochs, ':', doc_id)), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, target, CAST(epochs AS BIGINT) AS epochs,
  CAST(epochs * n_tokens + greatest(0, least(n_tokens, rest - pos)) AS BIGINT) AS taken FROM ordered"""


@register("op7_hierarchical_mixing", _OP7_ORACLE)
def op7_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION. Budgets through domain, language and source, and each leaf's token prefix."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", mixing.word_tokens().alias("words"), F.md5(F.col("text").cast("binary")).alias("text"))
    return mixing.mix(docs, source_domain(), weights=MIX_WEIGHTS, tokens=F.col("words"), **MIX).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "target", "epochs", "taken")


_SPECIAL = "</s>[INST] ok [/INST]"

_OP8_ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_SPECIAL}' UNION ALL SELECT -1, 1, 'assistant', '{_SPECIAL}'),
e AS (SELECT *, lag(role) OVER w AS before, length(replace(replace(role, '\', '\\'), '<|', '<\|')) AS role_chars,
  length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_chars FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN before IS NULL OR before <> role THEN role_chars + 8 + 8 + 7 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@register("op8_relational_chat", _OP8_ORACLE)
def op8_relational_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations and one with control-like texts, formatted and read back from the formatted text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    special = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(_SPECIAL).alias("text"))
    back = chat.read_back(chat.format_conversations(turns.unionByName(special)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("bigint").alias("formatted_chars"))


_OP10_ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS x FROM embeddings),
ok AS (SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
  AND list_inner_product(x, x) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, c.c AS component_id, v.vec_id = c.c AS kept
FROM v JOIN comp c ON v.vec_id = c.x LEFT JOIN degree d ON v.vec_id = d.x"""


@register("op10_iterative_quantisation", _OP10_ORACLE)
def op10_iterative_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION. Links of cosine >= 0.95 through learned binary codes, and their components."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


# Runs as islands of equal places q apart. A run of 6 words with q = 1, or of 4 * q words with q from 2 on, has five equal words
# in a row q apart, so only places that begin the same five words are joined. A stretch inside one of smaller period has that period.
# The crc32 is a fold over the bits of the decimal id, lowest first; 3988292384 is its fixed polynomial.
_OP11_ORACLE = f"""
WITH hashed AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w0, xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda ch: list_transform(range(8), lambda k: ((ascii(ch) >> k::INT) & 1)::BIGINT)))),
  lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1)))) AS h FROM documents),
placed AS (SELECT doc_id, w0, h, len(w0) AS n, CASE WHEN h % 10 = 0 AND len(w0) > 0 THEN (h // 10) % len(w0) END AS a FROM hashed),
tiled AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
texts AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w0 ELSE
  list_transform(range(n), lambda i: w0[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM tiled),
fives AS (SELECT doc_id, n, i, array_to_string(w[i + 1:i + 5], ' ') AS g FROM (SELECT *, unnest(range(n - 4)) AS i FROM texts WHERE n > 5)),
again AS (SELECT * FROM fives QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
places AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM again x JOIN again y ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM places) GROUP BY doc_id, q, island),
long AS (SELECT * FROM islands WHERE length >= greatest(6, 4 * q)),
runs AS (SELECT * FROM long r WHERE NOT EXISTS (SELECT 1 FROM long s WHERE s.doc_id = r.doc_id AND s.q < r.q AND s.start <= r.start
  AND s.start + s.length >= r.start + r.length)),
best AS (SELECT doc_id, start, length, q FROM runs r WHERE NOT EXISTS (SELECT 1 FROM runs s WHERE s.doc_id = r.doc_id
  AND (s.length * r.q > r.length * s.q OR (s.length * r.q = r.length * s.q AND (s.start, s.q) < (r.start, r.q))))),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
gone_list AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id)
SELECT t.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, CAST(b.length AS BIGINT) AS length, b.q AS period,
  CAST(1000 * b.length // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN k.g IS NULL THEN t.w ELSE
    list_transform(list_filter(range(t.n), lambda i: NOT list_contains(k.g, i)), lambda i: t.w[i + 1]) END, ' ')) AS collapsed_sha256
FROM texts t LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN gone_list k USING (doc_id)"""


def _tiled(text, doc_id):
    """The text, or for ids whose crc32 is divisible by 10 its words from a place on repeated with a period, both from that crc32."""
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def tiled(w):
        n, g = F.size(w).cast("bigint"), F.floor(h / 10)
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        place = F.array(F.struct(a.alias("a"), p.alias("p")))  # arrays of one: their lambda evaluates the inner part once
        return F.transform(place, lambda s: F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(
            w, F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int"))), " "))[0]

    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tiled(w)).otherwise(F.lit("")))[0]
    return F.when(h % 10 == 0, changed).otherwise(text)


@register("op11_descending_lcp_runs", _OP11_ORACLE)
def op11_descending_lcp_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every text (a tenth of them made periodic), the strongest one, and the texts without their repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = runs.periodic_runs(docs.select("doc_id", _tiled(F.col("text"), F.col("doc_id")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return out.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
                      F.floor(F.col("strongest.length") * 1000 / F.col("strongest.period")).alias("exponent_milli"),
                      F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                      F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


_OP12_ORACLE = """
WITH usable AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
scored AS (SELECT a.vec_id AS anchor, a.label AS own, b.vec_id AS other, b.label, CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
positives AS (SELECT anchor, other AS positive, score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.positive AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.other AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND n.label <> n.own AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor, p.positive ORDER BY n.score DESC, n.other)
QUALIFY row_number() OVER w <= 3"""


@register("op12_inverted_multi_index", _OP12_ORACLE)
def op12_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION. Hard negatives of every 50th vector, certified over the cells of an inverted multi-index."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return negatives.hard_negatives(vectors)


@register("op13_bounded_space_packing")
def op13_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ACTION. Ids of word_bpe_49k.json and an end id, packed into windows of 4096 by bounded-space best fit."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
