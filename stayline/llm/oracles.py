"""DuckDB counterparts of those queries that SQL can express; written on their own, values included."""

from __future__ import annotations

QUALITY_RULES = r"""
with base as (
    select doc_id, coalesce(text, '') as body from documents
), parts as (
    select doc_id, body,
        list_filter(string_split_regex(body, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as words,
        list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) as lines
    from base
), starts as (
    select doc_id, i, array_to_string(words[i:i + 4], ' ') as seen
    from (select doc_id, words, unnest(range(1, len(words) - 3)) as i from parts where len(words) >= 5)
), again as (
    select doc_id, i from starts qualify count(*) over (partition by doc_id, seen) > 1
), covered as (
    select doc_id, sum(step) as n from (
        select doc_id, least(5, coalesce(lead(i) over (partition by doc_id order by i) - i, 5)) as step from again
    ) group by doc_id
), counted as (
    select p.doc_id,
        len(words) as n_words,
        length(regexp_replace(body, '[ \t\n\x0B\f\r]+', '', 'g')) as word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
        len(lines) - len(list_distinct(lines)) as n_dup_lines,
        coalesce(c.n, 0) as n_repeat_words,
        length(regexp_replace(body, '[^\p{Lu}]+', '', 'g')) as n_upper,
        len(lines) as n_lines,
        len(list_filter(words, lambda x: list_contains(string_split(
            'a an and are as at be by for from has he in is it its of on or that the this to was were will with '
            || 'au avec ce dans de des du elle en est et la le les ne pas pour que qui se sur un une '
            || 'auf das dem den der die ein eine für ich im in ist mit nicht sich sie und von zu '
            || 'con como del el la las los no para por que se su una y '
            || 'A An And Are As At Be By For From Has He In Is It Its Of On Or That The This To Was Were Will With '
            || 'Au Avec Ce Dans De Des Du Elle En Est Et La Le Les Ne Pas Pour Que Qui Se Sur Un Une '
            || 'Auf Das Dem Den Der Die Ein Eine Für Ich Im In Ist Mit Nicht Sich Sie Und Von Zu '
            || 'Con Como Del El La Las Los No Para Por Que Se Su Una Y', ' '), x))) as n_stop
    from parts p left join covered c on p.doc_id = c.doc_id
), judged as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
        greatest(n_words, 1)::double as w
    from counted
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
    n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
    not base_failed and len(failed_rules) = 0 as kept, array_to_string(failed_rules, '; ') as failed_rules
from (
    select *, list_filter([
        case when n_symbols / w > 0.3 then 'symbols per word' end,
        case when n_upper / greatest(word_chars, 1)::double > 0.4 then 'upper case' end,
        case when word_chars / w < 1.5 or word_chars / w > 40 then 'mean word length' end,
        case when n_dup_lines / greatest(n_lines, 1)::double > 0.6 then 'repeated lines' end,
        case when n_words >= 60 and n_words * 0.01 - n_stop > 0 then 'stop words of texts long enough to have some' end
    ], lambda x: x is not null) as failed_rules
    from judged
)
"""

DECONTAMINATION = r"""
with doc_words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), item_words as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where item_id is not null
), windows as (
    select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as win
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item_words where len(w) > 0)
), runs as (
    select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
    from (
        select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from doc_words, (select distinct n from windows) where len(w) >= n
    )
), hits as (
    select r.doc_id, r.i, r.n, v.item_id from runs r join windows v on r.win = v.win and r.n = v.n
), hit_words as (
    select doc_id, count(distinct pos) as n_hit
    from (select distinct doc_id, unnest(range(i, i + n)) as pos from hits) group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
    from (select distinct doc_id, item_id from hits) group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
    coalesce(i.n_items, 0)::bigint as n_items, sha256(coalesce(i.ids, '')) as items_sha256,
    coalesce(h.n_hit, 0) > 0 as contaminated
from doc_words d left join hit_words h on d.doc_id = h.doc_id left join items i on d.doc_id = i.doc_id
"""

COLLOCATIONS = r"""
with pieces as (
    select lang, row_number() over () as piece, words from (
        select lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') as words from (
            select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) as p
            from documents
        )
    ) where len(words) > 0
), totals as (
    select lang, sum(len(words))::hugeint as n from pieces group by lang
), counted as (
    select lang, ids, count(*)::hugeint as f from (
        select lang, words[i:i + size - 1] as ids from (
            select lang, words, size, unnest(range(1, len(words) - size + 2)) as i
            from pieces, (select unnest(range(1, 6)) as size) where len(words) >= size
        )
    ) group by lang, ids having count(*) >= 100
), cuts as (
    select lang, ids, f, unnest(range(1, len(ids))) as k from counted where len(ids) > 1
), scored as (
    select c.lang, c.ids, c.f as a, t.n, x.f as l, y.f as r, c.k, (1000 * c.f * t.n) // (x.f * y.f) as score
    from cuts c join totals t on t.lang = c.lang
    join counted x on x.lang = c.lang and x.ids = c.ids[1:c.k]
    join counted y on y.lang = c.lang and y.ids = c.ids[c.k + 1:]
), best as (
    select * from scored qualify row_number() over (partition by lang, ids order by score, k) = 1
), inner_parts as (
    select distinct lang, ids[i:i + size - 1] as ids, f from (
        select lang, ids, f, size, unnest(range(1, len(ids) - size + 2)) as i
        from counted, (select unnest(range(2, 5)) as size) where len(ids) > size
    )
), kept as (
    select b.*, array_to_string(b.ids, ' ') as phrase from best b
    where not exists (select 1 from inner_parts p where p.lang = b.lang and p.ids = b.ids and 100 * p.f >= 100 * b.a)
)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase,
    a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from kept qualify rank <= 2000
"""

ORACLES = {
    "op4_decontamination": DECONTAMINATION,
    "op10_quality_rules": QUALITY_RULES,
    "op11_phrase_collocations": COLLOCATIONS,
}
