"""Registered queries of the text operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from firnspark.llm.alignment import aligned
from firnspark.llm.common import text_or_empty
from firnspark.llm.decontaminate import contaminated
from firnspark.llm.lexical import ranked
from firnspark.llm.licenses import TEMPLATES, scan
from firnspark.llm.merkle import edited_fingerprints
from firnspark.llm.near_dup import near_duplicates
from firnspark.llm.neighbours import nearest
from firnspark.llm.packing import pack, word_count
from firnspark.llm.sharding import balanced_shards
from firnspark.llm.suffix_dedup import without_repeats
from firnspark.llm.toxicity import toxicity
from firnspark.llm.url_filter import RULES, judge
from firnspark.llm.warc import archived
from firnspark.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies never share a bin: their component is the cluster."""
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", word_count().alias("size"), (text_or_empty() != "").alias("full"))
    alike = near_duplicates(docs).where("n_shingles > 0").select("doc_id", "component_id").dropna().distinct()
    sized = materialise(sized.join(alike, "doc_id", "left"), "sized")
    return pack(sized, size=F.col("size"), cluster=F.when(F.col("full"), F.col("component_id")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)
    return judge(table(spark, sf_dir, "pages"), spark.sql(f"select * from values {rules} as t(verdict, host, path)"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_license_scan, op3_suffix_array_dedup, op4_document_fingerprints, op5_balanced_shards,
        op6_toxicity, op7_url_filter, op8_minhash_near_dedup, op9_warc, op10_benchmark_decontamination,
        op11_tokenizer_alignment, op12_lexical_search, op13_nearest_neighbours,
    )
}

# The templates of the license scan; the rule that finds them is written anew below.
_NOTICES = TEMPLATES
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x{7F}]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x{7F}]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _places(phrase: str) -> str:
    parts = phrase.split()
    here = " and ".join(f"w[i + {j + 1}] = '{p}'" for j, p in enumerate(parts))
    return f"list_filter(range(len(w)), lambda i: {here})"


ORACLES: dict[str, str] = {
    "op2_license_scan": f"""
        with t as (select label, len(string_split(notice, ' ')) as size, list_distinct(string_split(notice, ' ')) as words
            from (values {", ".join(f"('{a}', '{b}')" for a, b in _NOTICES)}) v(label, notice)),
        d as (select row_number() over () n, doc_id, {_LOW} as low from documents),
        w as (select n, doc_id, regexp_extract_all(low, '{_WORD}') as w from d),
        p as (select n, doc_id, w, len(w) as n_words, {_places("mit license")} as m, {_places("apache license")} as a,
            {_places("general public license")} as g from w),
        c as (select n, label, words, len(list_intersect(list_distinct(w), words)) as most, w, size from w, t
            where len(list_intersect(list_distinct(w), words)) >= ceil(0.9 * len(words))),
        b as (select n, label, words, w[k * size + 1 : k * size + 2 * size] as part
            from (select *, unnest(range(0, (len(w) - 1) // size + 1)) as k from c)),
        k as (select n, label, len(list_intersect(list_distinct(part), words)) / len(words) as share from b
            where len(list_intersect(list_distinct(part), words)) >= ceil(0.9 * len(words))),
        f as (select n, list(distinct label) as more, max(share) as best, count(*) as n_blocks from k group by n)
        select doc_id, n_words::bigint as n_words, (len(m) + len(a) + len(g))::bigint as n_base,
            list_min(m || a || g)::bigint as first_word, list_max(m || a || g)::bigint as last_word,
            array_to_string(own, ',') as base_labels,
            array_to_string(list_sort(list_distinct(own || coalesce(more, []))), ',') as labels,
            case when len(m) + len(a) + len(g) > 0 then 1.0 else coalesce(best, 0.0) end::double as score,
            coalesce(n_blocks, 0)::bigint as n_blocks
        from (select *, (case when len(a) > 0 then ['apache'] else []::varchar[] end)
            || (case when len(g) > 0 then ['gpl'] else []::varchar[] end)
            || (case when len(m) > 0 then ['mit'] else []::varchar[] end) as own from p)
        left join f using (n)""",
    "op7_url_filter": r"""
        with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest from pages),
        h as (select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '') as host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from u),
        r(verdict, rh, rp) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
            ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        best as (select page_id, max_by(rh || rp, length(rh || rp)) as rule, max_by(verdict, length(rh || rp)) as verdict
            from h join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id)
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from h left join best using (page_id)""",
    "op9_warc": """
        with p as (select page_id, coalesce(html, '') as body from pages),
        d as (select page_id, strlen(body) as n, sha256(body) as digest from p),
        f as (select digest, min(page_id) as first from d group by digest)
        select page_id, n::bigint as payload_bytes, digest as payload_digest,
            case when n >= 100 and page_id > first then 'revisit' else 'response' end as record_type,
            case when n >= 100 and page_id > first then first end as refers_to
        from d join f using (digest)""",
    "op12_lexical_search": rf"""
        with d as (select row_number() over () as r, doc_id, regexp_extract_all({_LOW}, '{_TERM}') as w from documents),
        g as (select count(*) as n_docs, sum(len(w))::bigint as total from d where len(w) > 0),
        i as (select row_number() over () as k, item_id, regexp_extract_all({_LOW}, '{_TERM}') as w from
            (select distinct item_id, text from benchmark)),
        q as (select k, item_id, term, count(*) as c from (select k, item_id, unnest(w) as term from i) group by all),
        t as (select r, doc_id, n, term, count(*) as tf from (select r, doc_id, len(w) as n, unnest(w) as term from d)
            where term in (select term from q) group by all),
        f as (select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as weight from t, g group by term, n_docs),
        s as (select k, item_id, r, doc_id, sum(c * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // total))))::bigint
            as score from t join q using (term) join f using (term), g group by all)
        select item_id, row_number() over (partition by k order by score desc, doc_id)::int as rank, doc_id, score from s
        where score > 0 qualify rank <= 10""",
    "op4_document_fingerprints": r"""
        with d as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n from documents),
        o as (select *, coalesce(lead(text) over w, first_value(text) over w) as nxt from d window w as (order by doc_id desc
            rows between unbounded preceding and unbounded following)),
        e as (select *, substr(text, 1, n - n // 3) || substr(nxt, 1, n // 3) as edited from o),
        l as (select *, list_distinct(string_split_regex(regexp_replace(text, '([.!?])([ \t])', '\1' || chr(1) || '\2', 'g'), '[\x01\n]')) as own,
            list_distinct(string_split_regex(regexp_replace(edited, '([.!?])([ \t])', '\1' || chr(1) || '\2', 'g'), '[\x01\n]')) as new,
            list_distinct(string_split_regex(regexp_replace(nxt, '([.!?])([ \t])', '\1' || chr(1) || '\2', 'g'), '[\x01\n]')) as other,
            list_transform(string_split(text, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: sha256(p))) as tree,
            list_transform(string_split(edited, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: sha256(p))) as new_tree
            from e),
        r as (select *, list_transform(tree, lambda s: sha256(array_to_string(s, ''))) as nodes,
            list_transform(new_tree, lambda s: sha256(array_to_string(s, ''))) as new_nodes from l),
        x as (select *, list_position(list_transform(range(1, greatest(len(nodes), len(new_nodes)) + 1),
            lambda i: nodes[i] is distinct from new_nodes[i]), true) - 1 as es from r),
        y as (select *, case when es >= 0 and es < least(len(tree), len(new_tree)) then list_position(list_transform(
            range(1, greatest(len(tree[es + 1]), len(new_tree[es + 1])) + 1), lambda i: tree[es + 1][i] is distinct from new_tree[es + 1][i]), true) - 1 end as ep from x)
        select doc_id, n::bigint as n_chars, sha256(edited) as edited_sha256,
            sha256(len(nodes) || ':' || array_to_string(nodes, '')) as fingerprint,
            sha256(len(new_nodes) || ':' || array_to_string(new_nodes, '')) as edited_fingerprint,
            2.0 * len(list_intersect(own, new)) / (len(own) + len(new)) as near_edited,
            2.0 * len(list_intersect(own, other)) / (len(own) + len(other)) as near_next,
            nullif(es, -1)::bigint as edit_section, ep::bigint as edit_paragraph from y""",
}
