"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alula.llm import conversations, exact_dedup, language_id, licenses, main_text, minhash, mixing, multi_index, passages, pieces, suffix_merge, token_files, vector_codes
from alula.llm.common import held_out, table
from alula.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op1_exact_dedup",
    f"""
    with n as (select doc_id, {NORMAL} as norm from documents)
    select doc_id, max(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
           doc_id = max(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
    from n
    """,
)
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op4_minhash_near_dedup",
    rf"""
    with recursive n as (
      select doc_id, list_filter(string_split_regex({NORMAL}, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
    ), s as (
      select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) end as s from n
    ), e as (select doc_id, unnest(s) as g from s),
    c as (select a.doc_id as a, b.doc_id as b, count(*) as n from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by all),
    l as (
      select a, b from c join s x on x.doc_id = a join s y on y.doc_id = b
      where 100 * n >= 75 * (len(x.s) + len(y.s) - n)
    ), u as (select a, b from l union all select b, a from l),
    r as (select doc_id as a, doc_id as b from s union select r.a, u.b from r join u on u.a = r.b)
    select s.doc_id, len(s.s) as n_shingles, m.component_id, s.doc_id = m.component_id as kept
    from s join (select a, min(b) as component_id from r group by a) m on m.a = s.doc_id
    """,
)
def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_language_id")
def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train_language_id(docs, ~held_out(F.col("doc_id")))
    found = language_id.identify_languages(docs, model, ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"))


@query("op2_soft_mixing")
def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    rows = mixing.with_copies(*mixing.fit_mixture(docs, mixing.label_domains(labels), ["doc_id", "source"]))
    return rows.select("doc_id", "source", *[F.col(f"__{c}").alias(c) for c in ("n_tokens", "domain", "rate", "copies")])


@query("op3_token_files")
def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.stored_documents(token_files.read_token_files(spark, path))


@query("op5_sentencepiece")
def pieces_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])
    return found.select(
        "doc_id", F.size("__pieces").cast("long").alias("n_pieces"), F.col("__crc32").alias("ids_crc32"), F.col("__round_trip").alias("round_trip"),
        F.col("__pieces").alias("pieces"),
    )


@query(
    "op8_embedding_near_dedup",
    """
    with recursive v as (
      select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
    ), l as (
      select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id < b.vec_id
      where list_cosine_similarity(a.e, b.e) >= 0.9
    ), u as (select a, b from l union all select b, a from l),
    r as (select vec_id as a, vec_id as b from v union select r.a, u.b from r join u on u.a = r.b),
    c as (select a, min(b) as component_id from r group by a), d as (select a, count(*) as n from u group by a)
    select vec_id, coalesce(d.n, 0) as n_links, c.component_id, vec_id = c.component_id as kept
    from v join c on c.a = vec_id left join d on d.a = vec_id
    """,
)
def vectors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op6_main_text")
def main_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text.main_texts(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("page_id", "url", F.col("__text").alias("text"), F.col("__n_chars").alias("n_chars"))


@query("op10_quality_attention")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    found = passages.score_quality(docs, passages.train_quality(docs, labels), ["doc_id"])
    score = F.col("__score")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), F.when(score >= 0.5, 1).otherwise(0).alias("predicted"))


@query(
    "op7_licenses",
    r"""
    with n as (
      select doc_id, list_concat(
        list_transform(regexp_extract_all(coalesce(text, ''), 'Licensed under the Apache License, Version 2\.0'), lambda x: 'Apache-2.0'),
        list_transform(regexp_extract_all(coalesce(text, ''), 'Licensed under CC BY-NC 4\.0'), lambda x: 'CC-BY-NC-4.0'),
        list_transform(regexp_extract_all(coalesce(text, ''), 'licensed under the GNU General Public License, version 3'), lambda x: 'GPL-3.0'),
        list_transform(regexp_extract_all(coalesce(text, ''), 'All rights reserved'), lambda x: 'Proprietary'),
        list_transform(regexp_extract_all(coalesce(text, ''), 'Released under the MIT License'), lambda x: 'MIT')) as found
      from documents
    )
    select doc_id, len(found) as n_notices, array_to_string(list_sort(list_distinct(found)), ',') as families from n
    """,
)
def licenses_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licenses.scan_licenses(docs, licenses.train_licenses(docs), ["doc_id"])
    names = F.array_sort(F.array_distinct(F.transform("__notices", lambda x: x["family"])))
    return found.select("doc_id", F.size("__notices").cast("long").alias("n_notices"), F.array_join(names, ",").alias("families"))


def _vector_rounds() -> str:
    """SQL of the codebook rounds: every round's assignment, and the entries after it."""
    steps = []
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(
            f"""a{k} as materialized (
      select rn, part, min(struct_pack(d := d, entry := entry)) as m from (
        select p.rn, p.part, c.entry, list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, c.x) + list_dot_product(c.x, c.x) as d
        from p join c{k} c on p.part = c.part) group by all
    )"""
        )
        if k < vector_codes.ROUNDS:
            steps.append(
                f"""c{k + 1} as materialized (
      select c.part, c.entry, coalesce(n.x, c.x) as x from c{k} c left join (
        select part, entry, list(v order by pos) as x from (
          select a.part, a.m.entry as entry, pos, floor(sum(p.x[pos]) / count(*)) as v
          from a{k} a join p on a.rn = p.rn and a.part = p.part, range(1, (select size from w) + 1) g(pos) group by all) group by all
      ) n on n.part = c.part and n.entry = c.entry
    )"""
            )
    return ",\n    ".join(steps)


@query(
    "op11_vector_codes",
    f"""
    with v as materialized (
      select vec_id, label, row_number() over (order by vec_id nulls last, embedding) as rn,
        list_transform(embedding, lambda x: greatest(least(floor(1024 * x::double), 67108864), -67108864)) as q
      from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), w as (select greatest(1, (max(len(q)) + 3) // 4)::bigint as size from v),
    p as materialized (
      select rn, part, list_transform(range(1, size + 1), lambda i: coalesce(q[part * size + i], 0)::double) as x
      from v, w, range(4) r(part)
    ), c0 as materialized (select part, rn - 1 as entry, x from p where rn <= 256),
    {_vector_rounds()},
    h as (
      select sha256(string_agg(v::bigint::varchar, ',' order by part, entry, pos)) as h
      from (select part, entry, unnest(x) as v, unnest(range(len(x))) as pos from c{vector_codes.ROUNDS})
    ), e as (
      select rn, string_agg(lower(printf('%02x', m.entry)), '' order by part) as code, sum(m.d)::bigint as error
      from a{vector_codes.ROUNDS} group by rn
    )
    select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, h.h as codebooks_sha256
    from v join e using (rn), h
    """,
)
def vector_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode_vectors(table(spark, sf_dir, "embeddings"))


@query(
    "op12_suffix_dedup",
    """
    with d as materialized (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    c as (select doc_id, k, substr(h, k + 1, 712) as h from (select doc_id, h, unnest(range(0, len(h) - 198, 512)) as k from d where len(h) >= 200)),
    w as materialized (
      select doc_id, p, row_number() over (partition by md5(s) order by doc_id, p) > 1 as again from (
        select doc_id, k // 2 + i as p, substr(h, 2 * i + 1, 200) as s
        from (select doc_id, k, h, unnest(range(least(256, len(h) // 2 - 99))) as i from c))
    ), o as (select doc_id, p, coalesce(p > lag(p) over (partition by doc_id order by p) + 100, true) as opens from w where again),
    s as (select doc_id, p, sum(opens::int) over (partition by doc_id order by p) as span from o),
    r as (select doc_id, span, min(p) as a, max(p) + 100 as b from s group by all),
    k as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as before, lead(a) over (partition by doc_id order by a) is null as final from r),
    t as (
      select k.doc_id, count(*) as n_spans, sum(b - a)::bigint as n_removed,
        string_agg(substr(h, 2 * before + 1, 2 * (a - before)) || case when final then substr(h, 2 * b + 1) else '' end, '' order by a) as kept
      from k join d on d.doc_id = k.doc_id group by k.doc_id
    )
    select d.doc_id, len(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256
    from d left join t on t.doc_id = d.doc_id
    """,
)
def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_merge.remove_repeats(table(spark, sf_dir, "documents"))


def _before(letter: str, more: str, weight: str) -> str:
    """SQL of a weight (nine digits of cost, then the audit) with a letter in front."""
    return f"(lpad((left({weight}, 9)::bigint + {more})::varchar, 9, '0') || '{letter}' || substr({weight}, 10))"


def _repair_sql() -> str:
    """Backwards over rows for weights, forwards over the audit for the repaired rows."""
    follows = (2, 2, 3, 2)
    bits = "list_concat([xor(a, b)], range(8)::ubigint[])"
    crc = f"""xor(list_reduce(list_concat([4294967295::ubigint], list_transform(string_split(key, ''), lambda x: ascii(x)::ubigint)),
          lambda a, b: list_reduce({bits}, lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end)), 4294967295::ubigint)"""
    kept = {0: "case initial when 's' then w1 when 'u' then w2 end", 1: "case initial when 'u' then w2 end", 2: "case initial when 'a' then w3 end", 3: "case initial when 'u' then w2 end"}
    plain = ", ".join(
        f"least({_before('D', '3', f'w{s}')}, {_before('R', '2 + late', f'w{follows[s]}')}, {_before('K', 'late', f'({kept[s]})')}) as p{s}" for s in range(4)
    )
    once = ", ".join(f"least(p{s}, {_before('I', '2', f'p{follows[s]}')}) as o{s}" for s in range(4))
    twice = ", ".join(f"case when fault in (1, 2) then {_before('D', '3', f'w{s}')} else least(p{s}, {_before('I', '2', f'o{follows[s]}')}) end as w{s}" for s in range(4))
    wanted = "case state when 2 then 'assistant' else 'user' end"
    return rf"""
    with recursive c as (
      select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations
    ), e as materialized (select *, {crc} % 20 as code from c),
    d as (
      select conv_id, turn, case when code = 4 then 'user' else role end as role,
        case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(case when code = 3 then [0, 1] else [0] end) as copy
      from e where code <> 0
    ), n as (
      select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
        row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as k from d
    ), f as materialized (
      select *, left(role, 1) as initial, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1 when k > 1 then 2
        when regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 0 else 3 end as fault from n
    ), g as (
      select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate,
        count(*) filter (fault = 3) as truncated, max(i) as n, list(role order by i) as roles, list(text order by i) as texts, list(initial order by i) as initials from f group by conv_id
    ), w as (
      select conv_id, n + 1 as i, '000000000' as w0, '000000004II' as w1, '000000002I' as w2, '000000000' as w3 from g
      union all
      select conv_id, i, {twice} from (select *, {once} from (
        select f.conv_id, f.i, fault, initial, (fault = 3)::int as late, w0, w1, w2, w3, {plain} from w join f on f.conv_id = w.conv_id and f.i = w.i - 1))
    ), a as (
      select conv_id, substr(w0, 10) as rest, 1::bigint as i, 0 as state, []::varchar[] as done from w where i = 1
      union all
      select a.conv_id, substr(rest, 2), case when left(rest, 1) = 'I' then i else i + 1 end,
        case when left(rest, 1) = 'D' then state when left(rest, 1) = 'K' and initials[i] = 's' then 1 when state = 2 then 3 else 2 end,
        case left(rest, 1) when 'D' then done when 'I' then list_append(done, {wanted} || ':') when 'R' then list_append(done, {wanted} || ':' || texts[i])
          else list_append(done, roles[i] || ':' || texts[i]) end
      from a join g on g.conv_id = a.conv_id where rest <> ''
    )
    select b.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
      coalesce(len(list_filter(range(1, n), lambda i: initials[i] || initials[i + 1] not in ('su', 'ua', 'au'))), 0)::bigint as illegal,
      coalesce(left(w0, 9)::bigint, 0) as cost, coalesce(substr(w0, 10), '') as audit, sha256(coalesce(array_to_string(done, chr(10)), '')) as repaired_sha256
    from (select distinct conv_id from conversations) b left join g on g.conv_id = b.conv_id left join w on w.conv_id = b.conv_id and w.i = 1
      left join a on a.conv_id = b.conv_id and a.rest = ''
    """


@query("op13_conversation_repair", _repair_sql())
def conversation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(conversations.damage(table(spark, sf_dir, "conversations")))
