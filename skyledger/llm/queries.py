"""Registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.alignment import op12_alignment
from skyledger.llm.byte_pairs import op10_byte_pairs
from skyledger.llm.decontaminate import op1_decontaminate
from skyledger.llm.jaccard_join import op9_jaccard_join
from skyledger.llm.lexical_search import op11_lexical_search
from skyledger.llm.main_text import op8_main_text
from skyledger.llm.perplexity import op3_perplexity
from skyledger.llm.personal_data import op7_personal_data
from skyledger.llm.quality_classifier import op2_quality_classifier
from skyledger.llm.token_counts import op6_token_counts
from skyledger.llm.toxicity import op13_toxicity
from skyledger.llm.url_trust import op5_url_trust
from skyledger.llm.warc import op4_warc

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_perplexity": op3_perplexity,
    "op4_warc": op4_warc,
    "op5_url_trust": op5_url_trust,
    "op6_token_counts": op6_token_counts,
    "op7_personal_data": op7_personal_data,
    "op8_main_text": op8_main_text,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_byte_pairs": op10_byte_pairs,
    "op11_lexical_search": op11_lexical_search,
    "op12_alignment": op12_alignment,
    "op13_toxicity": op13_toxicity,
}

#: DuckDB SQL for the same rows, where SQL can express the operator.
SQL: dict[str, str] = {
    "op4_warc": """
        with pages_ as (
            select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                   sha1(coalesce(html, '')) as payload_digest
            from pages
        ), judged as (
            select *, max(page_id) over (partition by payload_digest) as newest from pages_
        )
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 1000 and page_id <> newest then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 1000 and page_id <> newest then newest end as refers_to,
               true as verified
        from judged
    """,
    "op9_jaccard_join": """
        with recursive worded as (
            select doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
            from documents
        ), sets as (
            select doc_id, case
                when len(w) = 0 then cast([] as varchar[])
                when len(w) < 4 then [array_to_string(w, ' ')]
                else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                end as own
            from worded
        ), shingle as (
            select doc_id, len(own) as n, unnest(own) as s from sets
        ), shared as (
            select a.doc_id as a, b.doc_id as b, a.n + b.n as both_sizes, count(*) as n
            from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id, a.n, b.n
        ), link as materialized (
            select a, b from shared where 100 * n >= 85 * (both_sizes - n)
        ), reach as (
            select doc_id, doc_id as reached from documents
            union
            select reach.doc_id, link.b from reach join link on reach.reached = link.a
        ), least_ as (
            select doc_id, min(reached) as component_id from reach group by doc_id
        )
        select doc_id, len(own) as n_shingles, component_id from sets join least_ using (doc_id)
    """,
    "op11_lexical_search": """
        with worded as (
            select doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9a-z\\x{80}-\\x{10FFFF}]+') as own
            from documents
        ), corpus as (
            select count(*) as n_docs, sum(len(own)) as n_terms from worded where len(own) > 0
        ), held as (
            select doc_id, 25 + 75 * len(own) * n_docs // n_terms as m, term, count(*) as tf
            from (select doc_id, own, unnest(own) as term from worded), corpus
            group by doc_id, own, n_docs, n_terms, term
        ), weighed as (
            select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
            from held, corpus group by term, n_docs
        ), asked as (
            select item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9a-z\\x{80}-\\x{10FFFF}]+')) as term
            from benchmark
        ), scored as (
            select item_id, doc_id, cast(sum(w * (1000000000 * tf // (1000 * tf + 8 * m))) as bigint) as score
            from asked join weighed using (term) join held using (term)
            group by item_id, doc_id
        ), ranked as (
            select item_id, doc_id, score,
                   cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
            from scored where score > 0
        )
        select item_id, rank, doc_id, score from ranked where rank <= 10
    """,
}
