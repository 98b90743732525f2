"""Template residue, filler and error pages.

1. *Templates.* Each content is a message, known by its longest line. Messages are mined with a prefix tree of fixed
   depth: the level of the line's token count, then its first three tokens, with numbers and codes masked. What
   reaches one leaf is one template. A leaf is classified once, from what all its messages say together:
   * it *recurs*, if it stands on many sites, the more the longer its messages are (a reposted article stands on a
     few, a message of a server on most), or
   * it is a *notice*, if most of its messages consist of lines that say what notices say.
   The verdict goes to all records of the leaf. In a leaf that only recurs, a record's other lines must recur as well.
2. *Filler.* A message made of words that hardly any longer text uses, while several sites' messages do.
3. *Slots.* Unfilled slots inside ordinary records are found separately, in title and content; a slot that is quoted
   or spoken about is none.

Null titles and contents count as empty; an empty content is no residue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cribble.operators.lineage import cut
from cribble.operators.skew import split_join

DEPTH = 3
#: Sites on which a template of no length recurs, the tokens that ask for as many again, and the most that are asked for.
SITES, LENGTH, MOST_SITES = 4, 15, 48
#: Words of a message that may be filler; longer texts are articles, whose words count against it.
MESSAGE = 60
#: Share of a filler's words, counted with repetition, that such messages have to themselves.
OWN = 0.5
MASK = r"[0-9]+|\b[b-df-hj-np-tv-z]{8,}\b"

# What a line of an error, access, deletion, maintenance, bot-check or script notice says.
NOTICES = [
    r"\A<\*> (bad gateway|not found|forbidden|unauthorized|service unavailable|gateway time-?out|internal server error|bad request|gone|too many requests|moved permanently)\z",
    r"(requested|this) (resource|page|url|document).{0,30}(not found|not exist|not available|no longer|unavailable)", r"\bpage (not found|cannot be displayed)",
    r"(upstream|gateway|server|backend).{0,30}(did not answer|timed? out|unavailable|not respond|too long)", r"try again later",
    r"(페이지|문서|자료|게시물|글|주소)를? 찾을 수 (없|가 없)", r"주소가 잘못", r"삭제되었을 수|변경되었을 수", r"\A(이전 화면|이전 페이지|메인|홈|목록|첫 화면)(으로|로)( 가기| 이동)?\z", r"\A다른 글 보기\z",
    r"오류가 발생", r"관리자에게 문의", r"\A(fatal error|warning|notice|exception|traceback|uncaught|parse error|error)\b.{0,120}", r"stack trace",
    r"권한이 없", r"열람이 제한", r"등급을 확인", r"접근이 (제한|차단|거부)", r"\Aaccess (to this page )?(is |has been )?denied",
    r"삭제된 (게시물|게시글|글|페이지|기사)", r"작성자의 요청", r"(비공개|블라인드) (처리된|게시물)", r"has been (removed|deleted)",
    r"(시스템|서버|서비스|정기) ?점검 중", r"점검 시간", r"이용이 (제한|중단)", r"잠시 후 다시", r"(under|scheduled) maintenance",
    r"(enable|turn on|requires?|needs?) (java ?script|cookies)", r"checking your browser", r"verify (that )?you are (a )?human", r"just a moment",
    r"자바스크립트를 (사용할 수 없|켜|허용|활성화)", r"스크립트 실행을", r"브라우저(입니다|를 업데이트)", r"비정상적인 접근", r"자동 등록 방지", r"(그림|보안)의? ?문자를 입력", r"로봇이 아닙",
    r"내용을 입력하세요", r"lorem ipsum",
    r"\A\W*(req|code|ref|trace|request|error|incident|id)\b[ :#=]*(<\*>|[a-z0-9-]+)\W*\z", r"\A<\*>\z",
]
LINE = "|".join(f"(?:{n})" for n in NOTICES)

# Forms of unfilled slots.
SLOTS = [
    r"\{\{[^{}\n]{1,60}\}\}", r"[$#]\{[^{}\n]{1,60}\}", r"<%[^%\n]{1,80}%>", r"%%[A-Z_]{2,40}%%", r"@@\w{1,40}@@", r"__[A-Z][A-Z_]{1,40}__", r"\[\[[^\[\]\n]{1,40}\]\]",
    r"&?\{[^{}\n\"':;=]{1,30}\}&?", r"\[object Object\]", r"\bNaN(?:년|월|일|원|%|\b)", r"<!--#\w+[^>\n]{0,60}-->", r"<\?(?:php|=)[^>\n]{0,60}\?>",
    r"\[(?:이름|성명|날짜|제목|내용|회사명?|기관명?|지역|금액|주소|연락처|전화번호|제목을 입력하세요|내용을 입력하세요|여기에 입력|name|date|title|company|your name)\]",
]
SLOT = "|".join(SLOTS)
#: A slot that someone quotes or speaks about.
QUOTED = r"[‘“\"'`「『]\s*(?:" + SLOT + r")\s*[’”\"'`」』]|(?:" + SLOT + r")\s*(?:이라는|라는|라고|같은|처럼|표기|표시|형식|문법|기호|문구|변수|값|자리|syntax|notation|placeholder)"
#: Titles that are nothing but a missing value or a form's hint.
BARE_TITLE = r"(?i)\A\s*(?:undefined|null|nan|none|\[?제목을 입력하세요\]?)(?:\s*[-|·]\s*[^-|·]{0,30}){0,2}\s*\z"


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def masked(c: Column) -> Column:
    """Lower case, numbers and codes as <*>, one blank between tokens, lines kept."""
    c = F.regexp_replace(F.lower(c), r"(?U)[\s\x1c-\x1f&&[^\n]]+", " ")
    return F.regexp_replace(F.regexp_replace(c, r" ?\n[ \n]*", "\n"), MASK, "<*>")


def has_slot(c: Column) -> Column:
    return F.regexp_replace(c, QUOTED, "").rlike(SLOT)


def lines_of(message: Column) -> Column:
    return F.filter(F.split(message, "\n"), lambda x: F.trim(x) != "")


def path(line: Column) -> Column:
    """The leaf of a masked line in the prefix tree: token count, then the first DEPTH tokens."""
    t = F.split(F.trim(line), " +")
    return F.xxhash64(F.size(t), *(F.coalesce(F.get(t, F.lit(i)), F.lit("")) for i in range(DEPTH)))


def _says(line: Column) -> Column:
    return F.trim(line).rlike(LINE)


def messages(docs: DataFrame) -> DataFrame:
    """(id, site, tokens, paths, main, said, slot): docs as messages. main: leaf of the longest line, paths: those of all
    lines, said: each line says what notices say. docs: id, site, title, content."""
    m = docs.select("id", F.xxhash64("site").alias("site"), _text("title").alias("title"), _text("content").alias("content")).select(
        "id", "site", lines_of(masked(F.col("content"))).alias("lines"), (has_slot(F.col("title")) | has_slot(F.col("content")) | F.col("title").rlike(BARE_TITLE)).alias("slot"))
    m = m.withColumn("longest", F.array_max(F.transform("lines", lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"])
    # the other lines are only looked at where the longest says something
    said = F.when(_says(F.col("longest")), F.forall("lines", _says)).otherwise(F.lit(False))
    tokens = F.aggregate("lines", F.lit(0), lambda n, x: n + F.size(F.split(F.trim(x), " +")))
    return m.select("id", "site", tokens.alias("tokens"), F.transform("lines", path).alias("paths"), path(F.col("longest")).alias("main"), F.coalesce(said, F.lit(False)).alias("said"), "slot")


def templates(m: DataFrame) -> DataFrame:
    """(main, n, sites, tokens, notice, recurs): leaves of the tree over all messages with their verdicts.

    sites: a lower bound of the number of sites, from a set of 64 bits.
    """
    t = m.where("size(paths) > 0").groupBy("main").agg(
        F.count("*").alias("n"), F.bit_count(F.bit_or(F.expr("shiftleft(1L, cast(pmod(site, 64) as int))"))).alias("sites"), F.avg("tokens").alias("tokens"), F.avg(F.col("said").cast("int")).alias("share"))
    need = F.least(SITES * (1 + F.col("tokens") / LENGTH), F.lit(float(MOST_SITES)))
    return t.select("main", "n", "sites", "tokens", (F.col("share") > 0.5).alias("notice"), (F.col("sites") >= need).alias("recurs"))


def of_templates(m: DataFrame) -> DataFrame:
    """(id): messages of leaves that are notices or recur, all of whose lines do."""
    known = cut(templates(m).where("notice or recurs").select("main", "n"))
    found = split_join(m.select("id", "site", "main", "paths", "said"), known, ["main"]).select("id", "site", "said", F.explode("paths").alias("path"))
    found = cut(found)
    line = found.groupBy("path").agg(F.count("*").alias("n"), F.bit_count(F.bit_or(F.expr("shiftleft(1L, cast(pmod(site, 64) as int))"))).alias("sites"), F.avg(F.col("said").cast("int")).alias("share"))
    line = cut(line.select("path", "n", ((F.col("sites") >= SITES) | (F.col("share") > 0.5)).alias("ok")))
    return split_join(found.select("id", "path"), line, ["path"]).groupBy("id").agg(F.bool_and("ok").alias("ok")).where("ok").select("id")


def fillers(docs: DataFrame) -> DataFrame:
    """(id): messages of at most MESSAGE words, most of whose words stand in such messages of several sites and hardly elsewhere."""
    words = F.filter(F.split(F.lower(F.col("content")), r"(?U)[\s\x1c-\x1f.,]+"), lambda x: x != "")
    d = docs.where("content is not null").select("id", F.xxhash64("site").alias("site"), words.alias("words"))
    short = F.size("words") <= MESSAGE
    bit = F.when(F.col("short"), F.expr("shiftleft(1L, cast(pmod(site, 64) as int))")).otherwise(F.lit(0).cast("long"))
    each = d.select("site", short.alias("short"), F.explode(F.array_distinct("words")).alias("word"))
    n = each.groupBy("word").agg(F.count("*").alias("n"), F.count_if("short").alias("shorts"), F.bit_count(F.bit_or(bit)).alias("sites"))
    own = cut(n.where((F.col("sites") >= 3) & (F.col("shorts") >= 0.8 * F.col("n"))).select("word", "n"))
    few = d.where(short).select("id", F.size("words").alias("all"), F.explode("words").alias("word"))
    return split_join(few, own, ["word"]).groupBy("id", "all").agg(F.count("*").alias("k")).where(F.col("k") >= OWN * F.col("all")).select("id")


def residue_ids(docs: DataFrame) -> DataFrame:
    """(id): records to exclude. docs: id, site, title, content."""
    m = cut(messages(docs))
    return m.where("slot").select("id").union(of_templates(m)).union(fillers(docs)).distinct()
