"""The registered queries of this folder, and their SQL where SQL can express them.

A query reads its whole table, applies one operator with its production parameters, and derives the columns of its
contract.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroband.llm import chunk_dedup, decontamination, line_dedup, mixing, periodic_runs, quality_rules, secret_scan
from aeroband.llm import sharding, simhash_dedup, suffix_dedup, token_alignment, token_files, url_rules
from aeroband.llm.texts import WORD
from aeroband.session import scratch_folder

TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark, sf_dir):
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op3_decontaminate(spark, sf_dir):
    """A row per document and benchmark item that a window of it is nearly equal to."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("doc")


def op4_simhash_golay(spark, sf_dir):
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("fp")


def op5_quality_rules(spark, sf_dir):
    records = quality_rules.ledger(table(spark, sf_dir, "documents"), ["doc_id"])
    return records.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"), quality_rules.passes().alias("kept"), "failures",
    )


def op6_line_dedup(spark, sf_dir):
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark, sf_dir):
    found = secret_scan.scanned(table(spark, sf_dir, "documents"))
    kinds = [kind for kind, *_ in secret_scan.PATTERNS]
    counts = [F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}") for kind in kinds]
    base = F.sha2(secret_scan.joined(F.col("spans"), kinds), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"))


def op8_chunk_dedup(spark, sf_dir):
    return chunk_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op9_url_rules(spark, sf_dir):
    return url_rules.judged(table(spark, sf_dir, "pages"))


def op10_token_files(spark, sf_dir):
    folder = f"{scratch_folder(spark)}/tokens"
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return token_files.read_checksums(spark, folder)


def op11_token_alignment(spark, sf_dir):
    found = token_alignment.Alignment(table(spark, sf_dir, "documents"), ["doc_id"], *map(tokenizer_path, ALIGNED))
    return found.documents().select("row.doc_id", *token_alignment.FIGURES, "n_best", "count_sum", "groups_sha256")


def with_planted_runs(docs):
    """``doc_id`` and ``text``; every tenth document by the checksum of its id repeats some of its words to its end."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rest = F.floor(checksum / 10)
    words = F.array(F.regexp_extract_all("text", F.lit(WORD), 0))

    def repeated(words):
        first = rest % F.size(words)
        period = 1 + F.floor((F.size(words) - first) / (3 + rest % 8))
        return F.array_join(F.transform(words, lambda word, i: F.get(
            words, F.when(i < first, i).otherwise(first + (i - first) % period).cast("int")
        )), " ")

    text = F.when(checksum % 10 == 0, F.transform(words, repeated)[0]).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs.runs(with_planted_runs(table(spark, sf_dir, "documents")), ["doc_id"])

    def rank(a, b):
        one, other = a["length"] * b["period"], b["length"] * a["period"]
        first = F.when(one > other, -1).when(one < other, 1)
        for name in ("start", "period"):
            first = first.when(a[name] < b[name], -1).when(a[name] > b[name], 1)
        return first.otherwise(0)

    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", F.get(F.array_sort("runs", rank), F.lit(0))).select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_jump_shards(spark, sf_dir):
    return sharding.placed(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in [
    op1_suffix_dedup, op2_mix_sources, op3_decontaminate, op4_simhash_golay, op5_quality_rules, op6_line_dedup,
    op7_secret_scan,
    op8_chunk_dedup, op9_url_rules, op10_token_files, op11_token_alignment, op12_periodic_runs, op13_jump_shards,
]}

ORACLE = {
    "op5_quality_rules": r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), windows as (
  select r, i, array_to_string(words[i:i + 7], ' ') as w
  from (select r, words, unnest(generate_series(1, len(words) - 7)) as i from d)
), again as (
  select r, i from (select r, i, count(*) over (partition by r, w) as n from windows) where n > 1
), repeats as (
  select r, count(distinct i + k) as n from again, generate_series(0, 7) as t(k) group by r
), lines as (
  select r, l from (select r, unnest(string_split(text, chr(10))) as l from d) where regexp_matches(l, '[^\x20\x09-\x0D]')
), line_counts as (
  select r, count(*) as n_lines, count(*) - count(distinct l) as n_dup_lines from lines group by r
), m as (
  select doc_id, len(words)::bigint as n_words,
         coalesce(list_sum([length(x) for x in words]), 0)::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
         coalesce(n, 0)::bigint as n_repeat_words
  from d left join repeats using (r) left join line_counts using (r)
), f as (
  select *, ((n_words < 20)::int + 2 * (100 * n_repeat_words > 30 * n_words)::int + 4 * (word_chars < 3 * n_words)::int
         + 8 * (word_chars > 10 * n_words)::int + 16 * (10 * n_symbols > n_words)::int
         + 32 * (2 * n_dup_lines > n_lines)::int)::bigint as failures
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & 3 <> 0 as base_failed, failures = 0 as kept, failures
from f
""",
    # The checksum is the bitwise one over all bytes, with its table made by its rule; the shard is the sequence as published.
    "op13_jump_shards": r"""
with recursive crc_step as (
  select i::bigint as b, i::bigint as v, 0 as turn from range(256) t(i)
  union all
  select b, case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end, turn + 1 from crc_step where turn < 8
), crc_table as (
  select list(v order by b) as crc_of from crc_step where turn = 8
), d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), texts as (
  select text, regexp_extract_all(hex(encode(text)), '..') as digits from (select distinct text from d)
), bytes as (
  select text, len(digits) as n, [4294967295::bigint] || [
    16 * (strpos('123456789ABCDEF', x[1])) + strpos('123456789ABCDEF', x[2]) for x in digits
  ] as seeded
  from texts
), sums as (
  select text, n, xor(list_reduce(seeded, lambda c, x: xor(c // 256, crc_of[xor(c % 256, x) + 1])), 4294967295) as text_crc32
  from bytes, crc_table
), jumps as (
  select r, ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 16))::hugeint as k, -1::bigint as b, 0::bigint as j from d
  union all
  select r, next_k, j, floor((j + 1) * (2147483648e0 / ((next_k // 8589934592)::double + 1)))::bigint
  from (select r, j, (k * 2862933555777941757 + 1) % 18446744073709551616 as next_k from jumps where j < 25)
), shards as (
  select r, (max(j) filter (where j < 24))::integer as shard, (max(j) filter (where j < 25))::integer as grown_shard from jumps group by r
)
select doc_id, (n + 8)::bigint as size, text_crc32::bigint as text_crc32, 'key' as law, shard,
  (row_number() over (partition by shard order by doc_id nulls first, n, text_crc32) - 1)::bigint as slot, grown_shard
from d join shards using (r) join sums using (text)
""",
}
