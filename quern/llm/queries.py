"""The registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import boilerplate, encode, languages, leakage, pairs, quality, sentences, site_lines, split, unmarked, vectors
from quern.runtime import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.text_kinds(table(spark, sf_dir, "raw_corpus"))


def p1_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every statistic of every record, with the probability of each kind."""
    return quality.text_statistics(table(spark, sf_dir, "raw_corpus"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_defects(table(spark, sf_dir, "qa_dataset"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.repeated_lines(table(spark, sf_dir, "raw_corpus"))


def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's text without the lines repeated in its source."""
    raw = table(spark, sf_dir, "raw_corpus")
    return site_lines.without_lines(raw, site_lines.repeated_lines(raw))


def p3_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines from the table merged in three deltas."""
    raw = table(spark, sf_dir, "raw_corpus").select("id", "text", "spider_name")
    slot = F.pmod(F.xxhash64("id"), F.lit(3))
    return site_lines.merged_lines([raw.where(slot == i) for i in range(3)])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.unnamed_languages(table(spark, sf_dir, "raw_corpus"))


def p4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every long line of natural prose, with its confidence."""
    return languages.line_languages(table(spark, sf_dir, "raw_corpus")).distinct()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.furniture_lines(table(spark, sf_dir, "raw_corpus"))


def p5_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's text with only its main content."""
    return boilerplate.main_texts(table(spark, sf_dir, "raw_corpus")).distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.piece_faults(table(spark, sf_dir, "embeddings_chunks"), table(spark, sf_dir, "raw_corpus"))


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every oversized record, cut anew."""
    return split.split_texts(table(spark, sf_dir, "raw_corpus"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_corpus(table(spark, sf_dir, "documents"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.mutual_pairs(table(spark, sf_dir, "embeddings_chunks"))


def p7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most similar vectors of other records for every vector, with cosine and rank."""
    return vectors.neighbours(table(spark, sf_dir, "embeddings_chunks"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passage of each leaked item in each document, with its edits."""
    return leakage.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.sentence_units(table(spark, sf_dir, "documents"))


def p10_unmarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units of every Chinese and Japanese document after its closing marks are taken out."""
    return unmarked.unmarked_units(table(spark, sf_dir, "documents"), strip=True)


QUERIES = {
    "p1_found": p1_found,
    "p1_statistics": p1_statistics,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_clean": p3_clean,
    "p3_deltas": p3_deltas,
    "p4_found": p4_found,
    "p4_lines": p4_lines,
    "p5_found": p5_found,
    "p5_main": p5_main,
    "p6_found": p6_found,
    "p6_pieces": p6_pieces,
    "p7_found": p7_found,
    "p7_neighbours": p7_neighbours,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_passages": p9_passages,
    "p10_found": p10_found,
    "p10_unmarked": p10_unmarked,
}
_WHITE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_LINES = rf"""
raw as (select id, any_value(text) as text, any_value(spider_name) as spider_name from raw_corpus where id is not null group by id),
lines as (select id, spider_name, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from raw where text is not null),
normal as (select id, spider_name, cast(line_no as integer) as line_no, regexp_replace(regexp_replace(regexp_replace(lower(line), '[{_WHITE}]+', ' ', 'g'), '^ | $', '', 'g'), '\p{{Nd}}+', '0', 'g') as line
    from lines where length(regexp_replace(line, '\P{{L}}', '', 'g')) >= {site_lines.MIN_LETTERS}),
often as (select spider_name, line from normal group by spider_name, line having count(distinct id) >= {site_lines.MIN_RECORDS}),
marked as (select distinct n.id, n.line_no from normal n join often o on n.line = o.line and n.spider_name is not distinct from o.spider_name)"""
_REPEATED = f"with {_LINES} select id, line_no from marked"
_UNIT = f"""
v as materialized (select id, any_value(coalesce(record_id, id)) as rec, any_value(embedding) as e, sqrt(any_value(list_sum(list_transform(embedding, lambda x: x * x)))) as norm
    from embeddings_chunks where id is not null and len(list_filter(embedding, lambda x: x is not null)) = {vectors.DIM} and len(embedding) = {vectors.DIM} group by id),
u as materialized (select id, rec, list_transform(e, lambda x: x / norm) as e from v where norm > 0)"""
ORACLES: dict[str, str] = {
    "p3_found": _REPEATED,
    "p3_deltas": _REPEATED,
    "p3_clean": f"""with {_LINES}
select r.id, case when r.text is null then null else (select coalesce(string_agg(l.line, chr(10) order by l.line_no), '') from lines l where l.id = r.id and l.line_no not in (select line_no from marked m where m.id = r.id)) end as text from raw r""",
    "p6_found": rf"""
with pieces as (select id, any_value(record_id) as record_id, any_value(table_name) as table_name, any_value(chunk_index) as chunk_index, any_value(chunk_text) as chunk_text from embeddings_chunks where id is not null group by id),
other as (select * from pieces where table_name is distinct from 'qa_dataset'),
texts as (select id, any_value(text) as text from raw_corpus where text is not null group by id),
before as (select distinct record_id, chunk_index + 1 as chunk_index, chunk_text as prev from other),
steps as (select o.id, bool_or(b.chunk_index is not null) as has,
        bool_or(coalesce(len(list_filter(range({split.OVERLAP}, least(length(b.prev), length(o.chunk_text)) + 1), lambda k: right(b.prev, k) = left(o.chunk_text, k))) > 0, false)) as ok
    from other o left join before b using (record_id, chunk_index) where o.chunk_index > 0 group by o.id)
select id, 'oversize' as fault from pieces where length(chunk_text) > {split.LIMIT}
union all select o.id, 'mid_word' from other o join texts t on t.id = o.record_id
    where o.chunk_text <> '' and strpos(t.text, o.chunk_text) > 0 and regexp_matches(right(o.chunk_text, 1), '[\pL\pN]') and regexp_matches(substr(t.text, strpos(t.text, o.chunk_text) + length(o.chunk_text), 1), '[\pL\pN]')
union all select id, case when has then 'no_overlap' else 'missing_before' end from steps where not ok""",
    "p7_found": f"""
with {_UNIT},
pairs as (select a.id, b.id as other, round(list_dot_product(a.e, b.e), 6) as c from u a join u b on a.rec <> b.rec and a.id <> b.id where list_dot_product(a.e, b.e) >= {vectors.MIN_COSINE} - 0.000001),
near as (select id, other from pairs where c >= {vectors.MIN_COSINE} qualify row_number() over (partition by id order by c desc, other) <= {vectors.K})
select x.id as id_a, x.other as id_b from near x join near y on y.id = x.other and y.other = x.id where x.id < x.other""",
}
