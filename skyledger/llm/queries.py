"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from skyledger.llm import chat, decontam, dedup, divergence, jaccard, licenses, mixing, quality, spelling, tokens, toxicity, urls, warc


def _read(spark, sf_dir: str, table: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_licenses(spark, sf_dir):
    """License signatures in every document."""
    return licenses.scan_licenses(_read(spark, sf_dir, "documents"))


def op2_url_filter(spark, sf_dir):
    """Judge every page's URL; the classifier learns from a bounded sample of URLs that rules judge."""
    pages = _read(spark, sf_dir, "pages")
    return urls.judge(pages, urls.fit(urls.rule_labels(pages)))


def op3_toxicity(spark, sf_dir):
    """Score every document with a network trained on the labelled rows that aren't held out."""
    docs = _read(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


def op4_quality(spark, sf_dir):
    """Score every document with a rule ensemble fitted on the labelled rows that aren't held out."""
    docs = _read(spark, sf_dir, "documents")
    return quality.quality(docs, quality.fit(docs, _read(spark, sf_dir, "labels")))


def op5_chat_format(spark, sf_dir):
    """Every conversation's prompts as tool calls linked to the replies."""
    return chat.link_tool_calls(*chat.turns_as_calls(_read(spark, sf_dir, "conversations")), chat.CHAT_TOOLS)


def op6_token_counts(spark, sf_dir):
    """Tokens of every document."""
    import public_tokenizers
    return tokens.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_mixing(spark, sf_dir):
    """Mix all documents to the sources' target weights."""
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_ngram_jaccard(spark, sf_dir):
    """Components of documents whose 5-word shingle sets have a similarity of 0.75 or more."""
    return jaccard.near_duplicate_components(_read(spark, sf_dir, "documents"))


def op9_exact_dedup(spark, sf_dir):
    """Which of the documents with equal normalised text stays."""
    return dedup.exact_duplicates(_read(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    """Every benchmark item searched in every document."""
    return decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark, sf_dir):
    """Divergence of every source from its language's other sources and from the language's own term shares."""
    return divergence.source_divergence(_read(spark, sf_dir, "documents"))


def op12_warc(spark, sf_dir):
    """Every page as a WARC record, written and read back."""
    return warc.archive_pages(_read(spark, sf_dir, "pages"))


def op13_spelling(spark, sf_dir):
    """Words of all documents with the likelier spelling one letter apart."""
    return spelling.spelling_variants(_read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_licenses, op2_url_filter, op3_toxicity, op4_quality, op5_chat_format, op6_token_counts, op7_mixing,
    op8_ngram_jaccard, op9_exact_dedup, op10_decontamination, op11_source_divergence,
    op12_warc, op13_spelling)}

ORACLE = {
    "op9_exact_dedup": r"""
        with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
        select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
               doc_id = min(doc_id) over g as kept, sha256(norm) as text_sha256
        from t window g as (partition by norm)
    """,
    "op8_ngram_jaccard": r"""
        with recursive w as (
            select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
        s as (
            select distinct doc_id, case when len(ws) < 5 then array_to_string(ws, ' ')
                   else array_to_string(ws[i:i + 4], ' ') end as sh
            from (select doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) as i from w where len(ws) > 0)),
        n as (select doc_id, count(*) as n from s group by doc_id),
        links as (
            select a.doc_id as a, b.doc_id as b
            from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id
            join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
            group by a.doc_id, b.doc_id, na.n, nb.n
            having 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
        reach as (
            select doc_id, doc_id as other from documents
            union
            select r.doc_id, l.b from reach r join links l on l.a = r.other)
        select d.doc_id, coalesce(max(n.n), 0) as n_shingles, min(r.other) as component_id
        from documents d join reach r on r.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
        group by d.doc_id
    """,
    "op11_source_divergence": r"""
        with d as (
            select row_number() over () as row_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
        occurrences as (select row_id, lang, source, unnest(terms) as term from d),
        kept as (select lang, term, count(*) as n from occurrences group by lang, term having count(distinct row_id) >= 10),
        langs as (select lang, count(*)::hugeint as v, sum(n)::hugeint as total from kept group by lang),
        counts as (select lang, source, term, count(*) as n from occurrences join kept using (lang, term) group by lang, source, term),
        grouped as (select distinct lang, source from d),
        shares as (
            select g.lang, g.source, k.term, coalesce(c.n, 0) as n, sum(coalesce(c.n, 0)) over (partition by g.lang, g.source) as total,
                   1 + (1000000000::hugeint * (k.n + 2)) // (l.total + 2 * l.v) as q, l.v
            from grouped g join kept k on k.lang = g.lang join langs l on l.lang = g.lang
            left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
        p as (select lang, source, term, n, q, 1 + (1000000000::hugeint * (n + 2)) // (total + 2 * v) as p from shares),
        pairs as (
            select a.lang, a.source, b.source as item, coalesce(s.value, 0) as value
            from grouped a join grouped b on b.lang = a.lang and b.source <> a.source
            left join (select x.lang, x.source, y.source as other, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) as value
                       from p x join p y on y.lang = x.lang and y.term = x.term group by all) s
                 on s.lang = a.lang and s.source = a.source and s.other = b.source),
        both_parts as (
            select lang, source, 'pair' as part, item, value::bigint as value from pairs
            union all
            select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint from p where n > 0 and p > q),
        ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from both_parts)
        select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 10
    """,
    "op12_warc": r"""
        with p as (select page_id, coalesce(html, '') as payload from pages),
        d as (select *, sha1(payload)::varchar as hex, row_number() over (partition by payload order by page_id nulls last) as k,
                     first_value(page_id) over (partition by payload order by page_id nulls last) as first_id from p)
        select page_id, octet_length(encode(payload))::bigint as payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ('0b' || substr(unhex(hex)::bit::varchar, (5 * i + 1)::int, 5))::int, 1)), '') as payload_digest,
               case when k = 1 then 'response' else 'revisit' end as record_type,
               case when k > 1 then first_id end as refers_to
        from d
    """,
    "op13_spelling": r"""
        with recursive crc_table as (
            select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                   lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
        runs as (
            select doc_id, run, count(*) as n
            from (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents)
            group by doc_id, run),
        hexed as (select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as bytes from runs),
        hashed as (
            select run, n, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(bytes) // 2),
                       lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::bigint)),
                       lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) as h
            from hexed, crc_table),
        words as (
            select word, sum(n)::bigint as n
            from (select n, case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed)
            where length(word) >= 7 group by word having sum(n) >= 2),
        less as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
                 from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
        near as (
            select a.word, a.n, b.word as other, b.n as other_n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
            union
            select a.word, a.n, b.word, b.n from less a join words b on a.rest = b.word
            union
            select b.word, b.n, a.word, a.n from less a join words b on a.rest = b.word),
        best as (
            select word, count(*) as n_near, max(other_n) as top_n, arg_min(other, (-other_n, other)) as top from near group by word),
        formed as (
            select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.top_n >= 10 * w.n then b.top end as form,
                   case when b.top_n >= 10 * w.n then b.top_n end as form_n
            from words w left join best b on b.word = w.word),
        follow as (
            select word, word as at, form as up from formed
            union all
            select f.word, f.up, g.form from follow f join formed g on g.word = f.up)
        select f.word, f.form, r.at as root, f.n, f.n_near, f.form_n
        from formed f join follow r on r.word = f.word and r.up is null
    """,
}
