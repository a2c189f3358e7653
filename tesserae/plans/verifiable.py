"""Queries of the verifiable subset, and their SQL.

The evaluation items stand for the instruction set: their questions are put into its forms, one item of each form a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sampling as S
from ..operators import verifiable as V
from .tables import PYWS, table

CLASSES = "farmland, harbor, River, parking lot, forest, Residential area, airport, lake, bridge, stadium"
TAIL = " Answer in one word or a short phrase."
#: Forms of yes/no questions; {n} is the object of the item's question.
FORMS = ("Is there a {n} in the image?", "Are there more {n} than small roads?", "Is the number of {n} equal to the number of large square buildings?", "Is a {n} next to a road present?", "Is the entire {n} flooded?", "Are there any {n}?")


def _items(spark: SparkSession, d: str) -> DataFrame:
    """(id, image, conversations) of the evaluation items, in both languages."""
    e = table(spark, d, "eval_items")
    low, q = F.lower("reference"), F.col("question")
    noun = F.regexp_extract(q, r"^Is there an? (.*) in the picture\?", 1)
    form = F.lit(FORMS[-1])
    for i, f in enumerate(FORMS[:-1]):
        form = F.when(F.col("item_id") % len(FORMS) == i, f).otherwise(form)
    asked = (
        F.when(q.startswith("What is the main scene"), F.concat(F.lit(f"<image>\nClassify the given image in one of the following classes. Classes: {CLASSES}."), F.lit(TAIL)))
        .when(noun != "", F.concat(F.replace(form, F.lit("{n}"), noun), F.lit(TAIL)))
        .when(low.isin("rural", "urban") | (F.col("item_id") % 7 == 0), F.lit("Is it a rural or an  urban area?" + TAIL))
        .otherwise(F.concat(F.lit("What is the overall condition of the given image? Flooded or Non Flooded."), F.lit(TAIL)))
    )
    said = F.when(low.isin("农村", "rural"), "Rural").when(low.isin("城市", "urban"), "urban").when(low == "是", "flooded").when(low == "否", "Non-Flooded").otherwise(F.col("reference"))
    image = F.when(q.startswith("What is the main scene") & (F.col("item_id") % 4 > 0), F.concat(F.lit("x/"), F.replace(low, F.lit(" "), F.lit("_")), F.lit("/a.png"))).when(F.col("item_id") % 5 > 0, F.concat(F.lit("y/scene/"), F.col("item_id").cast("string"), F.lit(".png")))
    turns = F.array(F.struct(asked.alias("value")), F.struct(said.alias("value")))
    return e.select(F.col("item_id").alias("id"), image.alias("image"), F.when(F.col("item_id") % 40 == 0, F.slice(turns, 1, 1)).otherwise(turns).alias("conversations"))


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return V.classify(_items(spark, d))


def _yesno(spark: SparkSession, d: str) -> DataFrame:
    y = _classified(spark, d).where("kind = 'binary_yesno'")
    return y.select("id", "question", V.yesno_subtype(F.col("question")).alias("subtype"), V.answer_label(F.col("reference")).alias("label"))


QUERIES = {
    "classify_verifiable": lambda spark, d: _classified(spark, d).select("id", "kind", "image", "question", "reference"),
    "yesno_subtype": lambda spark, d: _yesno(spark, d).select("id", "subtype"),
    "answer_label": lambda spark, d: _yesno(spark, d).select("id", "label"),
    "pool_report": lambda spark, d: V.pool_report(_classified(spark, d)),
    "scene_candidates": lambda spark, d: _classified(spark, d).where("kind = 'scene_classification'").select("id", F.array_join(V.scene_candidates(F.col("candidates"), F.col("image"), F.col("reference")), ",").alias("candidates")),
    "zh_reference": lambda spark, d: _classified(spark, d).where("kind is not null").select("id", V.zh_reference(F.col("kind"), F.col("reference")).alias("reference")),
    "zh_rows": lambda spark, d: V.localize(_classified(spark, d)),
    "translate_phrase": lambda spark, d: table(spark, d, "eval_items").select("item_id", V.translate_phrase(F.lower(F.regexp_extract("question", r"^Is there (.*?)(?: in the picture)?\?", 1))).alias("phrase")),
    "balanced_by_subtype": lambda spark, d: V.exclude(S.balanced(_yesno(spark, d), "label", 4, "id", by=("subtype",)), "subtype", {"other_yesno"}).select("id", "subtype", "label"),
    "preview_items": lambda spark, d: V.preview(_items(spark, d), 100, "id"),
}

_FORM = "case item_id % 6 " + " ".join(f"when {i} then '{f}'" for i, f in enumerate(FORMS)) + " end"
_NOUN = r"regexp_extract(question, '^Is there an? (.*) in the picture\?', 1)"
_I = f"""i as (select item_id as id, item_id,
        case when starts_with(question, 'What is the main scene') then '<image>' || chr(10) || 'Classify the given image in one of the following classes. Classes: {CLASSES}.{TAIL}'
            when {_NOUN} <> '' then replace({_FORM}, '{{n}}', {_NOUN}) || '{TAIL}'
            when lower(reference) in ('rural', 'urban') or item_id % 7 = 0 then 'Is it a rural or an  urban area?{TAIL}'
            else 'What is the overall condition of the given image? Flooded or Non Flooded.{TAIL}' end as q0,
        case lower(reference) when '农村' then 'Rural' when 'rural' then 'Rural' when '城市' then 'urban' when 'urban' then 'urban' when '是' then 'flooded' when '否' then 'Non-Flooded' else reference end as a0,
        case when starts_with(question, 'What is the main scene') and item_id % 4 > 0 then 'x/' || replace(lower(reference), ' ', '_') || '/a.png' when item_id % 5 > 0 then 'y/scene/' || item_id || '.png' end as image
    from eval_items),
    n as (select id, coalesce(nullif(image, ''), cast(id as varchar)) as image, regexp_replace(regexp_replace(replace(q0, '<image>', ''), '[{PYWS}]+', ' ', 'g'), '^ | $', '', 'g') as question,
        case when item_id % 40 = 0 then '' else a0 end as reference from i),
    c as (select *, list_filter(list_transform(string_split(case when regexp_matches(question, '(?i)^classify the given image') then regexp_extract(question, '(?i)classes: *(.*?)\\.? *answer in one word or a short phrase', 1) else '' end, ','), lambda x: lower(trim(x))), lambda x: x <> '') as cl,
        lower(replace(coalesce(split_part(image, '/', -2), ''), '_', ' ')) as folder, lower(reference) as low from n),
    k as (select id, image, question, reference, cl, low, case when question = '' or reference = '' then null
        when regexp_matches(question, '(?i)^classify the given image') then case when low <> 'none' and list_contains(cl, low) and (folder = '' or folder = low) then 'scene_classification' end
        when regexp_matches(question, '(?i)^is it a rural or an urban area') and low in ('rural', 'urban') then 'rural_urban'
        when regexp_matches(question, '(?i)^what is the overall condition') and low in ('flooded', 'non flooded', 'non-flooded') then 'flood_binary'
        when low in ('yes', 'no', 'yes.', 'no.') then 'binary_yesno' end as kind from c)"""
_SUB = r"""case when regexp_matches(lower(question), '^is the number of .* equal to the number of ') then 'count_equal_yesno'
    when regexp_matches(lower(question), '^(are there|is there|is a |is an |are any )') then case when regexp_matches(lower(question), '\b(more|less|fewer|larger|smaller|than)\b') then 'comparison_yesno' else 'presence_yesno' end
    when regexp_matches(lower(question), '^(is|are|does|do|can) ') and regexp_matches(lower(question), '\b(more|less|fewer|larger|smaller|than)\b') then 'comparison_yesno' else 'other_yesno' end"""
_LAB = "case when low in ('yes', 'yes.') then 'yes' when low in ('no', 'no.') then 'no' when low in ('non flooded', 'non-flooded') then 'non flooded' else low end"
_Y = f"y as (select id, question, {_SUB} as subtype, {_LAB} as label from k where kind = 'binary_yesno')"
_SCENE = "map {" + ", ".join(f"'{a}': '{b}'" for a, b in V.SCENE_ZH.items()) + "}"
_PICK = "list_sort(list_transform(list_filter(cl, lambda x: x <> low), lambda x: md5('pick|' || image || '|' || low || '|' || x) || x))"
_SIX = f"list_append(list_transform(({_PICK})[1:5], lambda x: substr(x, 33)), low)"

def _zh(c: str) -> str:
    """A noun phrase without a relation: article, adjectives, noun."""
    nouns, adjectives = ("map {" + ", ".join(f"'{a}': '{b}'" for a, b in m.items()) + "}" for m in (V.NOUN_ZH, V.ADJ_ZH))
    bare = f"regexp_replace(lower({c}), '^(a|an|the) +', '')"
    form = "'^((?:(?:" + "|".join(V.ADJ_ZH) + ")(?: |$))*)(.*)$'"
    noun = f"regexp_extract({bare}, {form}, 2)"
    return f"coalesce({nouns}[{bare}], array_to_string(list_transform(list_filter(string_split(regexp_extract({bare}, {form}, 1), ' '), lambda x: x <> ''), lambda x: {adjectives}[x]), '') || coalesce({nouns}[{noun}], {noun}))"


_P = lambda pattern, i=1: f"regexp_extract(question, '{pattern}', {i})"
_BIG = "大型方形建筑物"
ZH_ROWS = f"""{_I}, z as (select id, image, case kind
        when 'scene_classification' then '{V.SCENE_Q[0]}' || array_to_string(list_transform(case when len(cl) <= 6 then cl else list_transform(list_sort(list_transform({_SIX}, lambda x: md5('order|' || image || '|' || low || '|' || x) || x)), lambda x: substr(x, 33)) end, lambda x: coalesce({_SCENE}[x], x)), '、') || '{V.SCENE_Q[1]}'
        when 'rural_urban' then '{V.RURAL_Q}' when 'flood_binary' then '{V.FLOOD_Q}'
        when 'binary_yesno' then case
            when starts_with(question, 'Is the number of') then '图中' || {_zh(_P('^Is the number of (.*?) equal to'))} || '的数量和{_BIG}的数量一样多{V.YES_NO}'
            when starts_with(question, 'Are there more') then '图中' || {_zh(_P('^Are there more (.*?) than'))} || '比小型道路更多{V.YES_NO}'
            when starts_with(question, 'Is the entire') then '图中的整片' || {_zh(_P('^Is the entire (.*?) flooded'))} || '都被淹没{V.YES_NO}'
            when contains(question, ' next to a road') then '图中有道路旁边的' || {_zh(_P('^Is a (.*?) next to'))} || '{V.YES_NO}'
            when starts_with(question, 'Is there') then '图中有' || {_zh(_P('^Is there (.*?) in the image'))} || '{V.YES_NO}'
            else '{V.FALLBACK}' end end as question,
        case kind when 'scene_classification' then coalesce({_SCENE}[low], low) when 'binary_yesno' then case when low in ('yes', 'yes.') then '是' else '否' end
            when 'rural_urban' then case when low = 'rural' then '农村区域' else '城市区域' end else case when low in ('non flooded', 'non-flooded') then '非洪涝' else '洪涝' end end as reference,
        case when kind = 'binary_yesno' then {_SUB} end as subtype from k where kind is not null)"""

SQL = {
    "zh_rows": f"with {ZH_ROWS} select id, image, question, reference from z",
    "translate_phrase": f"with p as (select item_id, regexp_extract(question, '^Is there (.*?)(?: in the picture)?\\?', 1) as p from eval_items) select item_id, case when p <> '' then {_zh('p')} else '' end as phrase from p",
    "classify_verifiable": f"with {_I} select id, kind, image, question, reference from k",
    "yesno_subtype": f"with {_I}, {_Y} select id, subtype from y",
    "answer_label": f"with {_I}, {_Y} select id, label from y",
    "pool_report": f"""with {_I}, {_Y} select kind, 'label' as level, case when kind = 'scene_classification' then low else {_LAB} end as value, count(*) as cnt from k where kind is not null group by all
        union all select 'binary_yesno', 'subtype', subtype, count(*) from y group by all""",
    "scene_candidates": f"""with {_I} select id, array_to_string(case when len(cl) <= 6 then cl else list_transform(list_sort(list_transform({_SIX}, lambda x: md5('order|' || image || '|' || low || '|' || x) || x)), lambda x: substr(x, 33)) end, ',') as candidates
        from k where kind = 'scene_classification'""",
    "zh_reference": f"""with {_I} select id, case kind when 'scene_classification' then coalesce({_SCENE}[low], low) when 'binary_yesno' then case when low in ('yes', 'yes.') then '是' else '否' end
        when 'rural_urban' then case when low = 'rural' then '农村区域' else '城市区域' end else case when low in ('non flooded', 'non-flooded') then '非洪涝' else '洪涝' end end as reference from k where kind is not null""",
    "balanced_by_subtype": f"""with {_I}, {_Y}, r as (select *, row_number() over (partition by subtype, label order by md5('3407|' || id), id) as r from y),
        o as (select * from r qualify row_number() over (partition by subtype order by r, label) <= 4) select id, subtype, label from o where subtype <> 'other_yesno'""",
    "preview_items": f"with {_I} select id, image, q0 as question, a0 as reference from (select * from i order by id limit 100) where id % 40 <> 0",
}
