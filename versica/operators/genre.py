"""Genre of a verse text by ordered rules over its title and text, as column expressions; tune names are a broadcast array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Genre names and what titles and texts are recognised by.
SHI, CI, QU, FU, SAO, WEN, XINSHI, LIAN = "诗 词 曲 赋 骚 文 新诗 联".split()
SAO_TITLES = "离骚 九歌 九章 九辩 九怀 九叹 九思 七谏 招魂 大招 卜居 渔父 天问 远游 惜誓 哀时命 九守 胡笳十八拍 琴曲歌辞十二操".split()
PROSE_END = "(书|序|记|铭|箴|赞|颂|诔|碑|志|传|论|表|疏|诏|令|檄|策|说|解|启|笺|状|言|世家|列传|本纪|墓志铭|行状|神道碑|哀辞|祭文|吊文|连珠|引|疏证|文|辞)(并序|序)?$"
VERSE_END = "(杂言诗|七律|七绝|五律|五绝|排律|古风|歌行|行|篇|吟|歌|谣|操|辞)$"
NOTE_END = "(醉书|杂书|漫书|闲书|信笔书|书所见|书怀|书事|书感|书愤|书闷|书兴)$"
VERSE_START = "^(七律|七绝|五律|五绝|七言|五言|四言|六言|三言|排律|古风|歌行|杂言诗)"
NO_FU = "(赋此|赋示|赋呈|赋赠|赋答|赋谢|赋别|感赋|赋韵|为.*赋|归赋|中赋|夜赋|后赋|前赋|偶赋|漫赋|戏赋|醉赋|梦赋|再赋|重赋|同赋)$"
MODES = "^(双调|中吕|南吕|正宫|仙吕|越调|商调|黄钟|大石调|般涉调)[·・]"
NARRATIVE = "(少顷|既而|未几|俄而|须臾|忽闻|但闻|于是|遂命|乃命)"
STOPS = "[，。；！？、：,.;!?:]"
NUMBER = r"[一二三四五六七八九十百零〇\d]+"


def han_count(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, r"[^\x{4e00}-\x{9fff}]", ""))


def clauses(text: Column) -> Column:
    """Lengths of the clauses between stops, in Han characters, without empty ones."""
    return F.filter(F.transform(F.split(text, STOPS), han_count), lambda n: n > 0)


def base_title(title: Column) -> Column:
    """A title without book marks, a note in brackets at its end, and numbers of pieces."""
    t = F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"\s+", " ")), "[《》]", "")
    t = F.regexp_replace(t, "[（(][^）)]*[）)]$", "")
    for _ in range(2):
        t = F.regexp_replace(F.regexp_replace(t, f"{NUMBER}首$", ""), rf"[·・\s]*其{NUMBER}$", "")
    return F.trim(t)


def features(works: DataFrame, tunes: DataFrame) -> DataFrame:
    """works(title, lines, folder) with the features that rules ask for. tunes: name, n (its uses); a dictionary of a few thousand names."""
    names = tunes.agg(F.collect_list(F.struct("name", "n")).alias("_tunes"))
    w = works.withColumn("t", F.coalesce(F.trim("title"), F.lit(""))).withColumn("b", base_title(F.col("title"))).withColumn("body", F.array_join(F.coalesce("lines", F.expr("array()").cast("array<string>")), ""))
    w = w.withColumn("size", han_count(F.col("body"))).withColumn("cs", clauses(F.col("body"))).withColumn("n_clauses", F.size("cs"))
    share = lambda k: F.when(F.col("n_clauses") > 0, F.size(F.filter("cs", lambda x: x == k)) / F.col("n_clauses")).otherwise(0.0)
    w = w.withColumns({f"s{k}": share(k) for k in (3, 4, 5, 7)}).withColumn("longest", F.coalesce(F.array_max("cs"), F.lit(0)))
    w = w.withColumn("even", F.greatest("s3", "s4", "s5", "s7"))
    w = w.withColumn("verse", (F.col("n_clauses") >= 2) & (F.col("longest") <= 12) & ((F.col("s5") >= 0.6) | (F.col("s7") >= 0.6) | ((F.col("s4") >= 0.75) & (F.col("n_clauses") >= 4)) | ((F.col("s3") >= 0.6) & (F.col("n_clauses") >= 4))))
    dense = lambda pattern: F.regexp_count("body", F.lit(pattern)) / F.greatest(F.lit(1), F.col("size"))
    w = w.withColumn("particles", dense("[者也矣焉哉曰]")).withColumn("spoken", dense("[的了着吗呢吧啊]")).withColumn("xi", F.regexp_count("body", F.lit("兮")))
    w = w.join(F.broadcast(names))  # one row
    named = F.expr(r"filter(_tunes, x -> b = x.name OR (startswith(b, x.name) AND (substr(b, length(x.name) + 1, 1) RLIKE '[·・• 　（(:：-]' OR length(x.name) >= 3)) OR array_contains(split(b, '[·・ 　]'), x.name))")
    w = w.withColumn("_named", named).withColumn("tune", F.get(F.array_sort("_named", lambda x, y: F.char_length(y["name"]) - F.char_length(x["name"])), F.lit(0)))
    first, rest = F.get("lines", F.lit(0)), F.array_join(F.expr("slice(lines, 2, size(lines))"), "")
    of = lambda text, k: F.coalesce(F.size(F.filter(clauses(text), lambda x: x == k)) / F.nullif(F.size(clauses(text)), F.lit(0)), F.lit(0.0))
    preface = (F.size("lines") >= 3) & (han_count(first) >= 20) & ((of(rest, 5) >= 0.6) | (of(rest, 7) >= 0.6)) & (of(first, 5) < 0.6) & (of(first, 7) < 0.6)
    return w.withColumn("preface", F.coalesce(preface, F.lit(False))).drop("_named", "_tunes", "cs")


def classify(works: DataFrame, tunes: DataFrame, arias: list[str], aria_folders: list[str], early_folders: list[str], modern_folder: str) -> DataFrame:
    """works with genre: the first rule that holds decides."""
    w = features(works, tunes)
    c = F.col
    aria, early = c("folder").isin(aria_folders), c("folder").isin(early_folders)
    rare = (c("tune.n") <= 2) & (c("b") == c("tune.name")) & ((c("s5") >= 0.9) | (c("s7") >= 0.9)) & c("n_clauses").isin(4, 8)
    rare, tuned = F.coalesce(rare, F.lit(False)), c("tune.name").isNotNull()
    is_aria = F.arrays_overlap(F.array(*[F.lit(x) for x in arias]), F.concat(F.array("b"), F.split("b", "[·・ 　（(]"))) if arias else F.lit(False)
    regular = (c("n_clauses") >= 4) & ((c("s5") + c("s7") >= 0.8) | ((c("s3") >= 0.6) & (c("n_clauses") >= 8)) | (c("b").endswith("引") & c("verse")))
    prose_title = c("b").rlike(PROSE_END) | F.split("b", "[·・]")[0].rlike(PROSE_END)
    prosaic = ((c("size") >= 60) & ((c("particles") >= 0.03) | (c("longest") >= 45))) | ((c("size") >= 800) & (c("s3") + c("s5") + c("s7") < 0.5)) | ((c("size") >= 150) & (c("s3") + c("s5") + c("s7") < 0.35) & (c("particles") >= 0.015))
    filled = F.size(F.filter("lines", lambda x: F.trim(x) != ""))
    sao_title = F.array_contains(F.array(*[F.lit(x) for x in SAO_TITLES]), c("b")) | c("b").rlike("^(" + "|".join(SAO_TITLES) + ")[·・ ]")
    genre = (
        F.when(c("b").endswith("辞") & (c("xi") >= 3) & ~c("verse"), SAO)
        .when((c("folder") == modern_folder) & (c("size") >= 40) & (filled >= 10) & ~c("verse") & (c("spoken") >= 0.04) & (c("xi") == 0) & ~c("body").contains("曰") & (c("s5") + c("s7") < 0.5), XINSHI)
        .when(tuned & aria & is_aria & (c("tune.n") < 5), QU)
        .when(tuned & early & (c("n_clauses") >= 2) & (c("even") < 0.8) & ~rare, CI)
        .when(tuned & ~early & ~rare, CI)
        .when(c("b").endswith("诗") | c("b").endswith("辞"), SHI)
        .when(aria & (c("t").rlike("^【[^】]+】") | c("t").rlike(MODES) | is_aria | c("t").rlike("(套数|楔子|第[一二三四五六七八九十]+折)") | F.left("body", F.lit(20)).rlike("[〔【][^〕】]{2,8}[〕】]")), QU)
        .when(c("b").rlike("赋(并序)?$") & ~c("b").contains("赋得") & ~c("b").rlike(NO_FU) & (c("size") >= 60), FU)
        .when(sao_title, SAO)
        .when((c("xi") >= 4) & (c("xi") / F.greatest(F.lit(1), c("size")) >= 0.02) & ~c("verse") & ~c("b").rlike(PROSE_END), SAO)
        .when(c("b").rlike("(对联|长联|楹联|联语)$"), LIAN)
        .when(c("b").rlike(VERSE_START), SHI)
        .when(c("b").rlike(VERSE_END) | c("b").rlike(NOTE_END), SHI)
        .when(prose_title & regular, SHI)
        .when(prose_title, WEN)
        .when((c("size") >= 200) & (F.regexp_count("body", F.lit(NARRATIVE)) >= 3) & (c("even") < 0.5), WEN)
        .when((c("n_clauses") >= 10) & (c("longest") <= 8) & (c("even") >= 0.85), SHI)
        .when(c("preface"), SHI)
        .when(~c("verse") & prosaic, WEN)
        .otherwise(SHI)
    )
    return w.select(*works.columns, genre.alias("genre"))
