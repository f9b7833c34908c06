"""The corpus queries in plain SQL, where SQL has what they need."""

from __future__ import annotations

from kerbside.llm.license_scan import TEMPLATES
from kerbside.llm.spelling_variants import CAPITALS

# Fixed value: ASCII white space.
_BLANK = r"[\x20\x09-\x0D]"


def _words(table: str, key: str) -> str:
    return rf"select {key}, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') as w from {table}"


def _shingles(size: int) -> str:
    return f"list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8, byte by byte from its hexadecimal digits."""
    def entry(byte: int) -> int:
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        return byte

    table = "[" + ", ".join(str(entry(b)) for b in range(256)) + "]"
    digits = f"hex(encode({text}))"
    byte = f"cast('0x' || substr({digits}, 2 * i + 1, 2) as bigint)"
    values = f"list_transform(range(length({digits}) // 2), lambda i: {byte})"
    step = f"xor({table}[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {values}), lambda c, b: {step}), 4294967295::bigint)"


_LICENSES = "(values " + ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in TEMPLATES.items()) + ") l(license, text)"

EXPECTED_SQL: dict[str, str] = {
    "op2_decontamination": rf"""
        with item as (
            select item_id, len(w) as m, {_shingles(5)} as sh from ({_words("benchmark", "item_id")}) where len(w) >= 5
        ), item_shingle as (
            select item_id, m, unnest(sh) as s, generate_subscripts(sh, 1) - 1 as item_pos from item
        ), doc as (
            select doc_id, len(w) as n, {_shingles(5)} as sh from ({_words("documents", "doc_id")}) where len(w) >= 5
        ), doc_shingle as (
            select doc_id, n, unnest(sh) as s, generate_subscripts(sh, 1) - 1 as pos from doc
        ), windows as (
            select distinct doc_id, n, item_id, m, greatest(0, least(pos - item_pos, n - m)) as start
            from doc_shingle join item_shingle using (s)
        ), in_window as (
            select w.doc_id, w.n, w.item_id, w.m, w.start, d.s, count(*) as c
            from windows w join doc_shingle d on d.doc_id = w.doc_id and d.pos between w.start and w.start + w.m - 5
            group by all
        ), in_item as (
            select item_id, m, s, count(*) as c from item_shingle group by all
        ), common as (
            select doc_id, n, w.item_id, w.m, start, sum(least(w.c, i.c)) as common
            from in_window w join in_item i on i.item_id = w.item_id and i.s = w.s group by all
        ), alike as (
            select doc_id, item_id, start, common / (least(m, n - start) - 4 + m - 4 - common) as similarity from common
        )
        select doc_id, item_id, cast(start as int) as window_start, round(similarity, 9) as similarity
        from alike where similarity >= 0.8
        qualify row_number() over (partition by doc_id, item_id order by similarity desc, start) = 1""",
    "op7_license_scan": rf"""
        with template as (
            select license, greatest(8, cast(pow(2, ceil(log2(len(w)))) as int)) as class, list_distinct({_shingles(3)}) as sh
            from ({_words(_LICENSES, "license")})
        ), template_shingle as (
            select license, class, len(sh) as size, unnest(sh) as s from template
        ), doc as (
            select doc_id, {_shingles(3)} as sh from ({_words("documents", "doc_id")}) where len(w) >= 3
        ), doc_shingle as (
            select doc_id, unnest(sh) as s, generate_subscripts(sh, 1) - 1 as pos from doc
        ), windows as (
            select distinct doc_id, class, quarters, start_no * (class // 4) as start from (
                select doc_id, class, quarters, unnest(range(greatest(0, cast(ceil((pos + 3 - class * quarters / 4) / (class / 4)) as bigint)),
                                                             cast(floor(pos / (class / 4)) as bigint) + 1)) as start_no
                from (select distinct doc_id, class, pos, unnest([5, 8]) as quarters from doc_shingle join template_shingle using (s)))
        ), contained as (
            select w.doc_id, t.license, w.quarters, w.start, count(distinct t.s) / any_value(t.size) as containment
            from windows w
            join doc_shingle d on d.doc_id = w.doc_id and d.pos >= w.start and d.pos + 3 <= w.start + w.class * w.quarters / 4
            join template_shingle t on t.class = w.class and t.s = d.s
            group by w.doc_id, t.license, w.quarters, w.start
        )
        select doc_id, license, cast(start as int) as window_start, round(containment, 9) as containment
        from contained where containment >= 0.8
        qualify row_number() over (partition by doc_id, license order by quarters, containment desc, start) = 1""",
    "op8_line_dedup": rf"""
        with parts as (
            select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
        ), lines as (
            select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from parts
        ), keyed as (
            select *, translate(regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key from lines
        ), repeated as (
            select line_key, max(doc_id) as holder from keyed where length(line_key) >= 20
            group by line_key having count(distinct doc_id) >= 3
        ), marked as (
            select k.*, r.line_key is not null and k.doc_id <> r.holder as gone
            from keyed k left join repeated r using (line_key)
        )
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
        from marked group by doc_id""",
    "op12_conversation_trie": f"""
        with turn as (
            select conv_id, row_number() over (partition by conv_id order by turn nulls first) as n,
                   {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} as t
            from conversations where conv_id is not null
        ), own as (
            select conv_id, list(t order by n) as ts from turn group by conv_id
        ), plan as (
            select conv_id, ts, conv_id - conv_id % 5 as host, {_crc32("cast(conv_id as varchar)")} % 9 as h from own
        ), rebuilt as (
            select plan.conv_id, list_concat(coalesce(own.ts, [])[1:h], plan.ts[h + 1:]) as ts
            from plan left join own on own.conv_id = plan.host
        ), prefix as (
            select conv_id, len(ts) as size, d, ts[1:d] as ts from (select *, unnest(range(0, len(ts) + 1)) as d from rebuilt)
        ), node as (
            select d, ts, min(conv_id) as conv_id, count(*) as n_convs,
                   if(d = 0, 0, (count(*) - 1) * octet_length(encode(ts[d].text))) as saved,
                   sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (size = d), '')) as ends_sha256
            from prefix group by d, ts
        ), child as (
            select ts[1:d - 1] as ts, count(*) as n_children from node where d > 0 group by all
        ), above as (
            select unnest(range(0, d + 1)) as top, d, ts, saved, n_children is null as leaf from node left join child using (ts)
        ), subtree as (
            select ts[1:top] as ts, sum(cast(leaf as bigint)) as n_leaves, sum(saved) as saved_tokens from above group by all
        )
        select node.conv_id, node.d as depth, parent.conv_id as parent_conv_id, node.n_convs, coalesce(n_children, 0) as n_children,
               cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, node.ends_sha256
        from node join subtree using (ts) left join child using (ts) left join node parent on parent.ts = node.ts[1:node.d - 1] and node.d > 0""",
    "op13_spelling_variants": rf"""
        with run as (
            select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents
        ), lowered as (
            select doc_id, translate(run, '{CAPITALS}', '{CAPITALS.lower()}') as run, count(*) as times from run group by all
        ), hashed as (
            select run, times, {_crc32("coalesce(cast(doc_id as varchar), '') || ':' || run")} as h from lowered
        ), damaged as (
            select if(h % 31 = 0, substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2), run) as word, times from hashed
        ), word as (
            select word, cast(sum(times) as bigint) as n from damaged where length(word) >= 7 group by word having sum(times) >= 2
        ), hole as (
            select word, n, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail
            from (select *, unnest(range(1, length(word) + 1)) as i from word)
        ), near as (
            select a.word, a.n, b.word as near, b.n as near_n from hole a join hole b using (i, head, tail) where a.word <> b.word
            union select a.word, a.n, b.word, b.n from hole a join word b on b.word = a.head || a.tail
            union select b.word, b.n, a.word, a.n from hole a join word b on b.word = a.head || a.tail
        ), judged as (
            select word, n, count(near) as n_near, max(near_n) as top, arg_min(near, (-near_n, encode(near))) as best
            from word left join near using (word, n) group by word, n
        ), form as (
            select word, n, n_near, if(top >= 10 * n, best, null) as form, if(top >= 10 * n, top, null) as form_n from judged
        ), way as (
            with recursive step as (
                select word, coalesce(form, word) as root, form is null as done from form
                union all select step.word, coalesce(f.form, f.word), f.form is null
                from step join form f on f.word = step.root where not step.done
            ) select word, root from step where done
        )
        select word, form, root, n, n_near, form_n from form join way using (word)""",
}
