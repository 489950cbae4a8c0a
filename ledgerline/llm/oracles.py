"""SQL for the corpus queries whose every column SQL can say."""

from __future__ import annotations


def crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text: each byte is mixed in, then eight shifts (-1) follow."""
    steps = (
        f"flatten(list_transform(range(octet_length(encode({text}))::bigint), lambda i:"
        f" [('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    )
    return (
        f"xor(4294967295, list_reduce(list_concat([4294967295::bigint], {steps}), lambda crc, step: case when step >= 0 then xor(crc, step)"
        " when crc & 1 = 1 then xor(crc >> 1, 3988292384) else crc >> 1 end))"
    )


CONVERSATION_TRIE = f"""
with own as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, sha256(length(role) || ':' || role || text)) as position,
           role, text, sha256(length(role) || ':' || role || text) as digest
    from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
), members as (
    select conv_id, conv_id - conv_id % 100 as base, {crc32("conv_id::varchar")} % 6 as h from (select distinct conv_id from own)
), rebuilt as (
    select m.conv_id, o.position, 0 as part, o.digest, o.text from members m join own o on o.conv_id = m.base and o.position <= m.h
    union all
    select m.conv_id, o.position, 1 as part, o.digest, o.text from members m join own o on o.conv_id = m.conv_id and o.position > m.h
), lists as (
    select m.conv_id, coalesce(list(r.digest order by part, position) filter (r.digest is not null), []) as digests,
           coalesce(list(length(r.text) order by part, position) filter (r.digest is not null), []) as sizes
    from members m left join rebuilt r using (conv_id) group by m.conv_id
), prefixes as (
    select conv_id, depth, digests[1:depth] as node, digests[1:depth - 1] as parent, coalesce(sizes[depth], 0) as chars, len(digests) = depth as ends
    from (select *, unnest(range(len(digests) + 1)) as depth from lists)
), nodes as (
    select node, depth, any_value(case when depth > 0 then parent end) as parent, min(conv_id) as conv_id, count(*) as n_convs,
           any_value(chars) as chars,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
    from prefixes group by node, depth
), children as (
    select parent, count(*) as n from nodes where depth > 0 group by parent
), below as (
    select a.node, sum((d.n_convs - 1) * d.chars) as saved, count(*) filter (c.n is null) as leaves
    from nodes a join nodes d on d.depth >= a.depth and d.node[1:a.depth] = a.node left join children c on c.parent = d.node
    group by a.node
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs, coalesce(c.n, 0)::bigint as n_children,
       b.leaves::bigint as n_leaves, b.saved::bigint as saved_tokens, n.ends_sha256
from nodes n left join nodes p on n.parent = p.node and n.depth > 0 left join children c on c.parent = n.node join below b on b.node = n.node
"""

WARC = """
with payloads as (
    select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), firsts as (
    select *, min(page_id) over (partition by payload_digest) as first from payloads
), decided as (
    select *, case when payload_bytes >= 100 and first is not null and first is distinct from page_id then first end as refers_to from firsts
)
select page_id, payload_bytes, payload_digest, case when refers_to is null then 'response' else 'revisit' end as record_type, refers_to from decided
"""

SPELLING_VARIANTS = f"""
with recursive found as (
    select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents
), runs as (
    select id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from found where length(run) >= 7
), hashed as (
    select run, {crc32("id || ':' || run")} as h from runs
), spelt as (
    select case when h % 31 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word from hashed
), words as (
    select word, count(*) as n from spelt where length(word) >= 7 group by word having count(*) >= 2
), cuts as (
    select word, i, substr(word, 1, i) || substr(word, i + 2) as cut from (select word, unnest(range(length(word))) as i from words)
), pairs as (
    select distinct c.word, w.word as other from cuts c join words w on w.word = c.cut
), near as (
    select word, other from pairs
    union all select other, word from pairs
    union all select a.word, b.word from cuts a join cuts b on a.cut = b.cut and a.i = b.i and a.word <> b.word
), ranked as (
    select p.word, p.other, o.n as other_n, count(*) over (partition by p.word) as n_near,
           row_number() over (partition by p.word order by o.n desc, p.other) as place
    from near p join words o on o.word = p.other
), judged as (
    select w.word, w.n, coalesce(r.n_near, 0) as n_near, case when r.other_n >= 10 * w.n then r.other end as form,
           case when r.other_n >= 10 * w.n then r.other_n end as form_n
    from words w left join ranked r on r.word = w.word and r.place = 1
), chains as (
    select word, word as last, form as next from judged
    union all
    select c.word, j.word, j.form from chains c join judged j on j.word = c.next
)
select j.word, j.form, c.last as root, j.n::bigint as n, j.n_near::bigint as n_near, j.form_n::bigint as form_n
from judged j join chains c on c.word = j.word and c.next is null
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
with recursive words as (
    select doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') as words from documents
), shingles as (
    select doc_id, case when len(words) = 0 then [] when len(words) = 1 then [words[1]]
                        else list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) end as found
    from words
), sizes as (
    select doc_id, len(found)::bigint as n from shingles
), sets as (
    select min(doc_id) as doc_id, found, n from (select s.doc_id, list_sort(s.found) as found, z.n from shingles s join sizes z using (doc_id)) where n > 0 group by found, n
), each as (
    select doc_id, n, unnest(found) as shingle from sets
), shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as common, any_value(a.n) as a_n, any_value(b.n) as b_n
    from each a join each b on a.shingle = b.shingle and a.doc_id < b.doc_id and 100 * a.n >= 80 * b.n and 100 * b.n >= 80 * a.n
    group by a.doc_id, b.doc_id
), links as (
    select a, b from shared where 100 * common >= 80 * (a_n + b_n - common)
    union all select b, a from shared where 100 * common >= 80 * (a_n + b_n - common)
), reached as (
    select doc_id, doc_id as other from sets
    union
    select r.doc_id, l.b from reached r join links l on l.a = r.other
), roots as (
    select doc_id, min(other) as root from reached group by doc_id
), placed as (
    select s.doc_id, z.n, r.root from shingles s join sizes z using (doc_id)
    left join sets e on e.found = list_sort(s.found) and z.n > 0 left join roots r on r.doc_id = e.doc_id
)
select doc_id, n as n_shingles, coalesce(root, doc_id) as component_id, coalesce(root, doc_id) = doc_id as kept from placed
"""

DECONTAMINATION = f"""
with item_words as (
    select item_id::varchar as item_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from benchmark
), windows as (
    select distinct item_id, least(10, len(words)) as size,
           array_to_string(words[i:i + least(10, len(words)) - 1], ' ') as run
    from (select item_id, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) as i from item_words where len(words) > 0)
), doc_words as (
    select doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents
), starts as (
    select doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') as run
    from (select d.doc_id, d.words, s.size, unnest(range(1, len(d.words) - s.size + 2)) as i from doc_words d, (select distinct size from windows) s)
), hits as (
    select s.doc_id, s.i, s.size, w.item_id from starts s join windows w on w.run = s.run and w.size = s.size
), hit_words as (
    select doc_id, count(distinct place) as n from (select doc_id, unnest(range(i, i + size)) as place from hits) group by doc_id
), hit_items as (
    select doc_id, count(*) as n, string_agg(item_id, ',' order by item_id) as listed from (select distinct doc_id, item_id from hits) group by doc_id
)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(h.n, 0)::bigint as n_hit, coalesce(i.n, 0)::bigint as n_items,
       sha256(coalesce(i.listed, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
from doc_words d left join hit_words h using (doc_id) left join hit_items i using (doc_id)
"""
