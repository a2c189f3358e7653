"""SQL for the training-data queries that SQL can express on whole tables; the others are tested against brute force."""

from . import overlap as O
from . import truncation as T
from .common import ROOTS
from .splits import DERIVED

#: White space of any width at either end, case and the difference of '-' and '_' do not count.
_TYPE = r"replace(lower(regexp_replace({c}, '^[\s\x{{0B}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200F}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{2060}}\x{{3000}}\x{{FEFF}}]+|[\s\x{{0B}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200F}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{2060}}\x{{3000}}\x{{FEFF}}]+$', '', 'g')), '-', '_')"

#: Need, observed rows and bounds of every target.
_TARGETS = f"""s as (select sft_id, {_TYPE.format(c='question_type')} as k, source_dataset as d from sft),
        t as (select *, {_TYPE.format(c='question_type')} as k from sampling_targets),
        o as (select t.plan_id, t.source_dataset as d, t.question_type, t.k, t.target_share as share, t.min_rows, t.sample_rows, count(s.k) as observed_rows,
            cast(greatest(t.min_rows, floor(t.target_share * t.sample_rows + 0.5 + 1e-9)) as bigint) as need_rows
            from t left join s on s.k = t.k and (t.source_dataset is null or t.source_dataset = s.d) group by all)"""
#: Quotas: the level at which the shares, held between the minima and the rows there are, add up to the sample.
_QUOTAS = f"""{_TARGETS},
        b as (select *, least(min_rows, observed_rows)::double as low, greatest(least(min_rows, observed_rows), case when share > 0 then observed_rows else 0 end)::double as high, max(sample_rows) over (partition by plan_id) as n from o),
        p as (select plan_id, 0.0::double as x from b union select plan_id, low / share from b where share > 0 union select plan_id, high / share from b where share > 0),
        c as (select p.plan_id, x, any_value(n) as n, sum(least(greatest(x * share, low), high)) as total from p join b using (plan_id) group by 1, 2),
        e as (select *, lead(x) over w as x1, lead(total) over w as total1 from c window w as (partition by plan_id order by x)),
        v as (select plan_id, x + coalesce((n - total) * (x1 - x) / (total1 - total), 0) as x from e where total <= n + 1e-9 qualify row_number() over (partition by plan_id order by x desc) = 1),
        y as (select b.*, case when v.x is null then low * n / sum(low) over (partition by b.plan_id) else least(greatest(v.x * share, low), high) end as y from b left join v using (plan_id)),
        z as (select *, floor(y + 1e-9) as f, row_number() over (partition by plan_id order by round(y - floor(y + 1e-9), 6) desc, k) as place,
            floor(sum(y) over (partition by plan_id) + 0.5) - sum(floor(y + 1e-9)) over (partition by plan_id) as spare from y),
        q as (select *, cast(f + case when place <= spare then 1 else 0 end as bigint) as quota from z)"""

_WIDE, _NARROW = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)), "".join(chr(c) for c in range(0x21, 0x7F)).replace("'", "''")
#: Letters of every answer, all stretches of 12, and of each stretch that occurred before the letters up to the next one.
_REPEATS = f"""l as (select sft_id, coalesce(regexp_replace(lower(translate(regexp_replace(answer, '</?[A-Za-z][^<>]*>', '', 'g'), '{_WIDE}', '{_NARROW}')), '[^\\p{{L}}]+', '', 'g'), '') as t from sft),
        g as (select sft_id, i, substr(t, i, 12) as g from (select sft_id, t, unnest(generate_series(1, length(t) - 11)) as i from l where length(t) >= 12)),
        r as (select sft_id, i from g qualify i > min(i) over (partition by sft_id, g)),
        c as (select sft_id, sum(n) as covered from (select sft_id, least(12, coalesce(lead(i) over (partition by sft_id order by i) - i, 12)) as n from r) group by 1)"""

_SPACE = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200F}\x{2028}\x{2029}\x{202F}\x{205F}\x{2060}\x{3000}\x{FEFF}"


def _path(c: str) -> str:
    """One spelling for every way to write a file's path."""
    p = f"lower(replace(regexp_replace(translate({c}, '{_WIDE}　', '{_NARROW} '), '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g'), '\\', '/'))"
    p = f"case when contains({p}, '%') then lower(url_decode(replace({p}, '+', '%2B'))) else {p} end"
    p = f"string_split_regex(regexp_replace({p}, '^file:/+', ''), '/+')"
    steps = f"list_reduce(list_prepend([]::varchar[], list_transform({p}, lambda x: [x])), lambda acc, x: case when x[1] in ('', '.') then acc when x[1] = '..' then acc[:-2] else list_concat(acc, x) end)"
    return f"nullif(regexp_replace(array_to_string({steps}, '/'), '^(?:{'|'.join(ROOTS)})/', ''), '')"


def _scene(c: str) -> str:
    """The picture's path without its ending, dates, and the marks of pieces and copies."""
    p = f"regexp_replace(regexp_replace({_path(c)}, '\\.[a-z0-9]{{1,5}}$', ''), '{DERIVED}', '')"
    p = f"regexp_replace(regexp_replace({p}, '[_-](?:pre|post)(?:[_-]disaster)?($|[_-])', '\\1'), '{DERIVED}', '')"
    return f"regexp_replace({p}, '/(?:a|b|im1|im2|t1|t2|pre|post|before|after)/([^/]*)$', '/\\1')"


#: Classes of pictures: the least scene that is reached over the ties of the manifest.
_CLASSES = f"""i as (select distinct image from (select image from sft union all select image from val) where image is not null),
        p as (select image, {_scene('image')} as scene from i),
        m as (select distinct {_scene('image_path')} as a, {_scene('derived_from')} as b from manifest where image_path is not null and derived_from is not null),
        e as (select a, b from m where a <> b union select b, a from m where a <> b),
        w as (select a as n, a as o from e union select e.b, w.o from w join e on e.a = w.n),
        k as (select n, min(o) as c from w group by 1),
        c as (select image, coalesce(c, scene) as component from p left join k on k.n = p.scene where scene is not null)"""
#: Lengths of repeats: stretches of 12 that run on together, at the same distance from where they occurred before.
_LONGEST = """y as (select sft_id, max(m) + 11 as longest from (select sft_id, count(*) as m from (
            select a.sft_id, a.i - b.i as d, a.i - row_number() over (partition by a.sft_id, a.i - b.i order by a.i) as island from g a join g b on a.sft_id = b.sft_id and a.g = b.g and b.i < a.i) group by sft_id, d, island) group by 1)"""

_Q = lambda x: "'" + x.replace("'", "''") + "'"
_LETTERS = lambda w: f"array_to_string(list_sort(list_distinct(string_split({w}, ''))), '')"
_SAME = "map {" + ", ".join(f"{_Q(a)}: {_Q(b)}" for a, b in O.SAME_EN.items()) + "}"


def _asked(table: str, key: str, more: str = "") -> str:
    """Rows with the canonical picture, the canonical question, and its words where it is in Latin letters."""
    z = f"regexp_replace(regexp_replace(c, '[^\\p{{L}}\\p{{N}}]+', '', 'g'), '^(?:{O.OPENINGS_ZH}|{O.OPENINGS_EN.replace(' ', '')})+|(?:{O.CLOSINGS_ZH})+$', '', 'g')"
    once = "array_to_string(list_filter(string_split(z, ''), lambda x, i: not (x = '的' or (regexp_matches(x, '\\p{L}') and x is not distinct from string_split(z, '')[i + 1]))), '')"
    z2 = f"regexp_replace({once}, {_Q(O.CELL)}, '§\\1\\2§', 'g')"
    for old, new in O.WORDINGS:
        z2 = f"regexp_replace({z2}, {_Q(old)}, {_Q(new)}, 'g')"
    e = "trim(regexp_replace(c, '[^\\p{L}\\p{N}]+', ' ', 'g'))"
    e = f"regexp_replace(regexp_replace({e}, '^(?:(?:{O.OPENINGS_EN})(?: |$))+', ''), '(?:(?:^| )(?:{O.CLOSINGS_EN}))+$', '')"
    for old, new in O.IN_PLACE_EN:
        e = f"regexp_replace({e}, {_Q(old)}, {_Q(new.replace('$', chr(92)))}, 'g')"
    word = f"case when regexp_matches(w, '\\p{{N}}') then w else coalesce({_SAME}[{_LETTERS('w')}], w) end"
    shape = f"array_to_string(list_transform(words, lambda w: case when regexp_matches(w, '\\p{{N}}') then w else {_LETTERS('w')} end), ' ')"
    return f"""(select {key}, {more} img, words, nullif(case when words is null then {z2} else {shape} end, '') as q from (
            select *, {z} as z, case when not regexp_matches(c, '\\p{{Han}}') then list_transform(string_split({e}, ' '), lambda w: {word}) end as words from (
                select *, {_path('image')} as img, regexp_replace(lower(translate(question, '{_WIDE}　', '{_NARROW} ')), '<[^<>]*>', ' ', 'g') as c from {table} where image is not null and question is not null)) where img is not null)"""


_KNOWN = f"""v as (select w from (select unnest(list_distinct(string_split_regex(lower(translate(question, '{_WIDE}　', '{_NARROW} ')), '[^\\p{{L}}\\p{{N}}]+'))) as w
            from (select question from sft union all select question from val) where question is not null and not regexp_matches(question, '\\p{{Han}}')) group by w having count(*) >= {O.KNOWN}
        union select unnest([{', '.join(map(_Q, O.COMMON_EN.split()))}]))"""
_OVERLAPS = f"""s as materialized {_asked('sft', 'sft_id', 'source_dataset,')}, h as materialized {_asked('val', 'val_id')}, {_KNOWN},
        b as (select sft_id, val_id, source_dataset, list_filter(list_zip(s.words, h.words), lambda x: x[1] <> x[2]) as d from s join h using (img, q)),
        x as (select sft_id, val_id, unnest(d) as d from b),
        bad as (select sft_id, val_id from x where levenshtein(d[1], d[2]) > {O.SLIP} or (d[1] in (select w from v) and d[2] in (select w from v))
            or d[1] in ({', '.join(map(_Q, O.NUMBERS_EN.split()))}) or d[2] in ({', '.join(map(_Q, O.NUMBERS_EN.split()))})),
        o as (select * from b where not exists (select 1 from bad where bad.sft_id = b.sft_id and bad.val_id = b.val_id))"""



def _marked(c: str) -> str:
    tagged = f"case when contains({c}, '<') then regexp_replace({c}, '</?[A-Za-z]{{1,20}}>|<[/A-Za-z]{{0,20}}$', chr(10), 'g') else {c} end"
    old, new = T._STOPS + T._COMMAS + T._DIGITS, T.STOP * len(T._STOPS) + T.COMMA * len(T._COMMAS) + "#" * len(T._DIGITS)
    return f"translate({tagged}, {_Q(old)}, {_Q(new)})"


_BARE = lambda c: f"regexp_replace(trim({c}, {_Q(T.TRIM)}), '##+', '#', 'g')"
_ENDING = lambda c: f"case when regexp_matches({c}, '[a-z]$') then right({c}, 8) else right({c}, 4) end"
_AS = lambda c: f"[{''.join(chr(92) + x if x in '^]-' + chr(92) + '[' else x for x in c)}]"
#: The stack of closing marks that are awaited.
_STACK = f"""list_reduce(list_prepend('', string_split(regexp_replace(r, '[^{_AS(T.OPENING + T.CLOSING)[1:]}', '', 'g'), '')), lambda acc, x: case when x <> '' and instr({_Q(T.OPENING)}, x) > 0 then acc || substr({_Q(T.CLOSING)}, instr({_Q(T.OPENING)}, x), 1)
            when x <> '' and right(acc, 1) = x then left(acc, length(acc) - 1) else acc end)"""
_CLOSED = f"{_AS(T.STOPS)}{_AS(T.CLOSERS)}*$|[)）】]$|</[A-Za-z]{{1,20}}>$"
_CUTS = f"""texts as (select 'sft' as record_set, sft_id as row_id, source_dataset as source, answer as text from sft union all select 'val_pred', pred_id, run_name, prediction from val_pred),
        corpus as (select answer as text from sft union all select prediction from val_pred union all select question from sft),
        sentences as (select x as s, count(*) as n from (select unnest(string_split({_marked('text')}, {_Q(T.STOP)})[:-2]) as x from corpus where text is not null) where x <> '' group by 1),
        parts as (select n, string_split(lower(rtrim(s, {_Q(T.COMMA + ' ')})), {_Q(T.COMMA)}) as a from sentences),
        tokens as (select * from (select case when i = 1 then 'f' else 'm' end as place, {_BARE('t')} as token, i = k as last, n from (select n, unnest(a) as t, generate_subscripts(a, 1) as i, len(a) as k from parts)) where token <> ''),
        vocabulary as (select place, token, sum(case when last then n else 0 end) as ends, sum(case when last then 0 else n end) as goes_on from tokens group by 1, 2),
        tails as (select {_ENDING('token')} as tail, sum(n) as t from tokens where last group by 1),
        a0 as (select *, rtrim(text, {_Q(T.BLANKS + '*；;')}) as r, length(text) as n_chars from texts where text is not null),
        a1 as (select *, right(r, 1) as z from a0),
        a2 as (select * from a1 where z <> '' and not case when instr({_Q(T.CLOSERS)}, z) > 0 then regexp_matches(r, {_Q(_CLOSED)}) else instr({_Q(T.STOPS)}, z) > 0 and not (z = '.' and regexp_matches(r, '\\n[0-9]{{1,3}}[.、]$')) end),
        a3 as (select *, lower({_marked("rtrim(regexp_replace(r, '<[/A-Za-z]{0,20}$', ''), " + _Q(T.BLANKS + '；;') + ")")}) as m,
            regexp_replace(r, '(?s)^(?:.*<answer>|[{_SPACE}*]*(?:回答|答案|answer|Answer)\\*+)', '') as body from a2),
        a4 as (select *, string_split(m, {_Q(T.STOP)})[-1] as final, trim(case when contains(r, '<') or contains(r, '*') then lower({_marked('body')}) else m end, {_Q(T.TRIM + T.STOP)}) as whole,
            regexp_matches(r, '[?？][{_SPACE}"''”’]*[^?？{T.STOPS}\\n]*$') as asks, {_STACK} <> '' as open from a3),
        a5 as (select *, {_BARE(f"string_split(final, {_Q(T.COMMA)})[-1]")} as token, not contains(final, {_Q(T.COMMA)}) as one from a4),
        c as (select record_set, row_id, source, n_chars, token, case when one then 'f' else 'm' end as place, {_ENDING('token')} as tail,
            instr(',，、:：�.', z) > 0 or open as sure, one and (asks or {_BARE('whole')} = token) as alone from a5
            where length(whole) > 24 or not regexp_matches(whole, '^(?:{T.STAND_INS})?$') or z = '�'),
        asked as (select distinct place, token from c where not sure and token <> ''),
        nodes as (select q.place, q.token, sum(case when v.token = q.token then ends else 0 end) as e, sum(case when v.token = q.token then goes_on else 0 end) as g, sum(case when v.token = q.token then 0 else ends + goes_on end) as b
            from asked q join vocabulary v on v.place = q.place and left(v.token, 1) = left(q.token, 1) and starts_with(v.token, q.token) group by 1, 2),
        j as (select c.*, coalesce(e, 0) as e, coalesce(g, 0) as g, coalesce(b, 0) as b, coalesce(t, 0) as t from c left join nodes on nodes.place = c.place and nodes.token = c.token left join tails on tails.tail = c.tail),
        lengths as (select record_set, source, n_chars, count(*) as n from j where not (alone and e > 0) group by all),
        near as (select x.record_set, x.source, x.n_chars, x.n, sum(y.n) as m from lengths x join lengths y on x.record_set = y.record_set and x.source is not distinct from y.source and y.n_chars between x.n_chars - 8 and x.n_chars + 8 group by all),
        piles as (select * from near where n >= {T.PILE_ROWS} and n > {T.PILE} * greatest((m - n) / 16.0, 0.5)),
        k as (select j.*, p.n is not null as piled from j left join piles p on p.record_set = j.record_set and p.source is not distinct from j.source and p.n_chars = j.n_chars),
        cuts as (select record_set, row_id, source from k where case when sure then true when token = '' then false
            when e > 0 then not e >= (case when piled then 0.5 when alone then 0.0 else 0.2 end) * (e + g + b) when g + b > 0 and alone and g = 0 and t > 0 then false when g + b > 0 then true else t = 0 end)"""

SQL: dict[str, str] = {
    "p4_found": f"with {_CUTS} select record_set, row_id from cuts",
    "p4_rates": f"""with {_CUTS} select record_set, source, count(*) as n_rows, count(k) as n_truncated, round(count(k) / count(*)::double, 6) as rate
        from (select t.record_set, t.source, u.row_id as k from texts t left join cuts u on u.record_set = t.record_set and u.row_id = t.row_id) group by 1, 2""",
    "p5_found": f"with {_OVERLAPS} select sft_id, val_id from o",
    "p5_report": f"with {_OVERLAPS} select 'val' as split_name, source_dataset, count(*) as pairs, count(distinct sft_id) as train_rows, count(distinct val_id) as held_rows from o group by source_dataset",
    "p3_found": f"with recursive {_CLASSES} select a.image as image_a, b.image as image_b from c a join c b using (component) where a.image < b.image",
    "p3_scenes": f"with recursive {_CLASSES} select image, component, count(*) over (partition by component) - 1 as links from c",
    "p6_share": f"with {_REPEATS}, {_LONGEST} select sft_id, length(t) as letters, coalesce(covered / length(t)::double, 0) as repeated_share, coalesce(longest, 0) as longest_repeat from l left join c using (sft_id) left join y using (sft_id)",
    "p6_found": f"with {_REPEATS} select sft_id from l join c using (sft_id) where covered / length(t)::double >= 0.4",
    "p1_found": f"with {_TARGETS} select plan_id, question_type from o where observed_rows < need_rows",
    "p1_quotas": f"with {_QUOTAS} select plan_id, question_type, observed_rows, need_rows, quota, greatest(0, need_rows - observed_rows) as missing_rows, greatest(0, need_rows - quota) as short_rows from q",
    "p1_sample": f"""with {_QUOTAS} select plan_id, q.question_type, sft_id from q join s on s.k = q.k and (q.d is null or q.d = s.d)
        qualify row_number() over (partition by plan_id, q.question_type order by md5('3407|' || plan_id || '|' || sft_id)) <= any_value(quota) over (partition by plan_id, q.question_type)""",
}
