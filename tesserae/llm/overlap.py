"""Problem 5: the same or near-same records in the training and the evaluation split.

Method: records are canonicalised (width, case, punctuation, white space, courtesy, wordings, doubled and swapped letters),
hashed, and evaluation hashes are joined with training hashes; matches are counted by split and source. Words in Latin
letters enter the hash by their letters alone; pairs in which words differ are then looked at word by word: a number word, two
established words (common ones, or ones that KNOWN rows hold), or more than a slip of the pen make them different questions.

Defined results: rows with a null or blank image or question match nothing; a question without any letter or digit
matches nothing; repeated rows match each; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fits, narrow, once, sift, with_path

#: Openings and closings that ask nothing themselves.
OPENINGS_ZH = "请问|请看图|请告诉我|请看|用户提问|提问|问题|问|你好|您好|麻烦问一下|想问一下"
CLOSINGS_ZH = "谢谢你|谢谢您|谢谢|请直接回答|请简要回答|请简短回答|请回答|一句话作答|一句话回答|直接回答|简要回答|多谢"
OPENINGS_EN = "please tell me|please tell|please|question|q|user question|hello|hi"
CLOSINGS_EN = "thanks|thank you|please|answer briefly|please answer briefly|answer directly|please answer directly|one sentence|in one sentence|answer in one sentence|briefly"
#: Wordings that mean the same in questions; each is replaced by the right-hand side.
WORDINGS = (
    ("图片|影像|画面|图象|照片|图像", "图"),
    ("图中", "图"),
    ("是否分布有|是否存在|是否有|是否含有|是否具有", "是否有"),
    ("能否看到|能不能看到|可否看到|是否能看到|能看到", "能看到"),
    ("有没有|有无|是否有", "是否有"),
    ("哪一个方位|哪个方位|哪一方位|哪个方向|哪一方向|哪方位", "哪方位"),
    ("一共|总共|共计|合计", "共"),
    ("多少处|多少个|几处|几个", "几处"),
    ("分布在什么位置|分布在什么地方|分布在哪里|分布在哪儿|分布在哪", "分布在哪"),
    ("呈现什么颜色|呈什么颜色|是什么颜色|什么颜色", "什么颜色"),
    ("大致处于|大概处于|大致位于", "大致处于"),
    ("哪一侧|哪侧|哪一边|哪边", "哪侧"),
)
WORDINGS_EN = {
    "image": "picture|photo|photograph|image",
    "seen": "spotted|seen|observed|found",
    "contain": "contain|show|include|have",
    "located": "situated|placed|located|positioned",
    "color": "color|colour",
    "can": "can|could",
}


#: The same where they stand in a question, though not elsewhere.
IN_PLACE_EN = ((r"\b(?:which|what) colou?r (?:is|has)\b", "what color is"), (r"^(whe\p{L}+) lies\b", "$1 is"))


def letters_of(word: str) -> str:
    """A word by its different letters in order: swapped and doubled letters make no difference."""
    return "".join(sorted(set(word)))


SAME_EN = {letters_of(w): k for k, ws in WORDINGS_EN.items() for w in ws.split("|")}
#: Ways to name the numbered cell that a question is about: the number before or behind the word for a cell.
_CELL = "(?:网格|格网|格子|方格|单元格)"
CELL = rf"在?第?(?:标号|编号|序号|号码)?(\d+)号?{_CELL}[中里内]?|在?第?{_CELL}(?:标号|编号|序号|号码)?(\d+)号?[中里内]?"
#: Number words, and common words that differ from others only in the order or number of their letters.
NUMBERS_EN = "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand first second third once twice no none"
COMMON_EN = "a an the is are was were am as at it its in on of off or to too so if no not now own won how who show from form for there their these those this that than then left felt right east seat west north south up down above below near over under top bottom side edge center centre middle large small round area road roads boat port part sport tree river dam mad"
#: Rows that make a word an established one, and edits that make a slip (two swapped letters are two).
KNOWN, SLIP = 20, 2


def with_question(df: DataFrame, source: str, name: str, words: str) -> DataFrame:
    """df with the form under which questions are compared, null if nothing is asked, and the words of those in Latin letters."""
    df = once(df, _c=F.regexp_replace(F.lower(narrow(F.col(source))), r"<[^<>]*>", " "))
    # Chinese and mixed questions: a run of letters and digits without spaces
    z = F.regexp_replace("_c", r"[^\p{L}\p{N}]+", "")
    z = F.regexp_replace(z, f"^(?:{OPENINGS_ZH}|{OPENINGS_EN.replace(' ', '')})+|(?:{CLOSINGS_ZH})+$", "")
    z = F.regexp_replace(z, r"的|(\p{L})(?=\1)", "")
    z = F.regexp_replace(z, CELL, "§$1$2§")
    for old, new in WORDINGS:
        z = F.regexp_replace(z, old, new)
    # questions in Latin letters: words, each as its sorted letters, so that swapped and doubled letters don't matter
    e = F.trim(F.regexp_replace("_c", r"[^\p{L}\p{N}]+", " "))
    e = F.regexp_replace(e, f"^(?:(?:{OPENINGS_EN})(?: |$))+", "")
    e = F.regexp_replace(e, f"(?:(?:^| )(?:{CLOSINGS_EN}))+$", "")
    for old, new in IN_PLACE_EN:
        e = F.regexp_replace(e, old, new)
    same = F.create_map(*[F.lit(x) for kv in SAME_EN.items() for x in kv])
    letters = lambda w: F.array_join(F.array_sort(F.array_distinct(F.split(w, ""))), "")
    latin = ~F.col("_c").rlike(r"\p{IsHan}")
    df = once(df, _e=F.when(latin, F.transform(F.split(e, " "), lambda w: F.when(w.rlike(r"\p{N}"), w).otherwise(F.coalesce(F.try_element_at(same, letters(w)), w)))))
    shape = F.array_join(F.transform("_e", lambda w: F.when(w.rlike(r"\p{N}"), w).otherwise(letters(w))), " ")
    return once(df, **{name: F.nullif(F.when(latin, shape).otherwise(z), F.lit("")), words: F.col("_e")}).drop("_c", "_e")


def keyed(rows: DataFrame, *cols: str, pictures: DataFrame | None = None) -> DataFrame:
    """The given columns with the canonical image and question; rows without either are left out.

    pictures (_img): rows of other pictures may be left out before their questions are looked at.
    """
    k = with_path(rows.select(*cols, "image", "question").where("image is not null and question is not null"), "image", "_img").drop("image").where("_img is not null")
    k = k if pictures is None else sift(k, "_img", pictures)
    return with_question(k, "question", "_q", "_w").drop("question").where("_q is not null")


def overlaps(train: DataFrame, held: DataFrame, train_id: str = "sft_id", held_id: str = "val_id") -> DataFrame:
    """(train_id, held_id, source_dataset): all pairs of rows with the same file that ask the same.

    The join key is the hash of both canonical forms, so a picture that holds a third of the rows spreads over its
    questions; equal canonical forms are compared in full after the hash join.
    """
    h = cut(keyed(held, held_id))
    t = keyed(train, train_id, "source_dataset", pictures=h)
    t = t.select(train_id, "source_dataset", F.xxhash64("_img", "_q").alias("_h"), F.col("_img").alias("_ti"), F.col("_q").alias("_tq"), F.col("_w").alias("_tw"))
    h = h.select(held_id, F.xxhash64("_img", "_q").alias("_h"), "_img", "_q", "_w")
    both = t.join(h, "_h").where("_ti = _img and _tq = _q").select(train_id, held_id, "source_dataset", F.filter(F.arrays_zip(F.col("_tw").alias("x"), F.col("_w").alias("y")), lambda p: p["x"] != p["y"]).alias("_d"))
    both = cut(both.withColumn("_u", F.monotonically_increasing_id()))
    alike = both.where("_d is null or size(_d) = 0")
    slips = both.where("size(_d) > 0")
    if fits(slips, 0):
        return alike.select(train_id, held_id, "source_dataset")
    known = vocabulary(train, held)
    odd = slips.select("_u", F.inline("_d"))
    odd = odd.join(known.select(F.col("word").alias("x"), F.lit(True).alias("_kx")), "x", "left").join(known.select(F.col("word").alias("y"), F.lit(True).alias("_ky")), "y", "left")
    word = lambda c: F.coalesce(F.col(f"_k{c}"), F.col(c).isin(COMMON_EN.split()))
    number = F.col("x").isin(NUMBERS_EN.split()) | F.col("y").isin(NUMBERS_EN.split())
    other = odd.where(number | (word("x") & word("y")) | (F.levenshtein("x", "y") > SLIP)).select("_u").distinct()
    return alike.unionByName(slips.join(other, "_u", "left_anti")).select(train_id, held_id, "source_dataset")


def vocabulary(*tables: DataFrame) -> DataFrame:
    """(word) of the words in Latin letters that at least KNOWN questions hold."""
    words = None
    for t in tables:
        q = t.select("question").where("question is not null").where(~F.col("question").rlike(r"\p{IsHan}"))
        w = q.select(F.explode(F.array_distinct(F.split(F.lower(narrow(F.col("question"))), r"[^\p{L}\p{N}]+"))).alias("word"))
        words = w if words is None else words.unionAll(w)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= KNOWN).select("word")


def report(train: DataFrame, held: DataFrame, split: str = "val", train_id: str = "sft_id", held_id: str = "val_id") -> DataFrame:
    """Numbers of pairs and of different rows on either side, per split and source."""
    return (
        overlaps(train, held, train_id, held_id)
        .groupBy("source_dataset")
        .agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct(train_id).alias("train_rows"), F.countDistinct(held_id).alias("held_rows"))
        .select(F.lit(split).alias("split_name"), "source_dataset", "pairs", "train_rows", "held_rows")
    )
