"""Texts cut off by field limits or broken transfers.

Two kinds of evidence:

* A longer copy. Every text, and every text without the mark of a cut behind it, is looked up among the beginnings of
  all longer texts. Texts are hashed at fixed lengths of 1, 2, 4, 8, ... characters; a text looks up its longest such
  prefix among those of the others, which tells which texts could continue it and at which lengths (fewer than twice
  the prefix). Only those are then hashed at just these lengths, and a text whose whole hash is among them is a strict
  prefix. No pair of texts is formed, equal texts count once, and no length is left out. The mark behind a text is no
  part of it: a text goes on in another only if that is longer without its mark, so none is a longer copy of itself.
* The end itself: a mark of a cut behind a broken sentence, a broken entity, tag, escape or character, or a last
  sentence that neither closes nor is a usual ending (sign-off, list item, notice, tag, caption).

A text with a longer copy is cut if the copy goes on within the word, or if the text's end doesn't close a sentence.
Ends that could be either (a plain verb form without a stop) count as cut only with a longer copy. Null, empty and
blank texts are not cut.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cribble.operators.lineage import cut

#: Characters of the end that are looked at first; where a mark or sounds fill them, twice as many, and so on.
TAIL_CHARS = 160

# Marks that a field limit or a list page leaves behind a cut text.
MARK = re.compile(r"\s*(?:(?:\.{2,}|…+)\s*)?(?:\[?\s*(?:전문보기|전문 보기|더보기|더 보기|계속 읽기|read more|more|continue reading|continued)\s*\]?|\((?:계속|중략|이하 생략|continued|more)\))\s*$|\s*(?:\.{3,}|…+)\s*$", re.I)
#: How every MARK ends, by its last 9 characters at most; most texts need no search for it.
MARK_END = re.compile(r"(?:\.{3}|…|보기|읽기|more|reading|continued|[\])])$", re.I)
#: What only a break leaves: the replacement character, a part of an escape, of an entity or of a tag, a lone jamo of a syllable.
BROKEN = re.compile(r"(?:�+|\\u?[0-9a-fA-F]{0,3}|&[a-zA-Z]{1,7}|&#x?[0-9a-fA-F]{0,6}|<[a-zA-Z/!][^<>]{0,80}|<|%[0-9A-F]?|[ᄀ-ᇿ\ud800-\udfff])$")
CLOSED = re.compile(r"[.!?。！？][\"'”’)\]』」]*$")
# Sounds and signs behind a complete sentence.
TAIL = re.compile(r"(?:[\s~^ㅋㅎㅠㅜ;:!.…♥♡☆★]|:\)|:\(|\^\^|\((?:끝|end|완)\)|[\U0001F300-\U0001FAFF☀-➿️])+$")
# Complete texts end in such lines.
ENDINGS = re.compile(
    r"(?:이상입니다|감사합니다|고맙습니다|thanks in advance|many thanks|thank you|regards|cheers|hope this helps|to be continued|힘드네요|도와주세요|부탁드려요|부탁드립니다|모르겠어요|계속됩니다|드립니다|수고하세요|라고 물었다|궁금합니다|죄송합니다|staff|reporter|desk)[\"”’)]*$"
    r"|\[[^\[\]]{1,20}\]$|(?:^|\n)\s*(?:#\S+\s*)+$|(?:^|\n)\s*(?:-|–|—|\d+[.)])\s*\S.{0,40}$|(?:^|\n)\s*(?:출처|사진|자료|글|편집|제공|문의|source|photo|related|credit|note)\b.{0,50}$|제공 \S{1,10}$"
    r"|무단 ?전재|재배포 금지|all rights reserved|게시판 참고|드림$|올림$",
    re.I,
)
#: Verb forms that close a sentence in speech; a cut may end there by chance.
VERB = re.compile(r"(?:[다요죠까네]|니다|세요)$")


def tail_of(t: str) -> str:
    """So much of the end that it begins before any mark, sounds or signs at the end."""
    n = TAIL_CHARS
    while n < len(t):
        end = t[-n:]
        m, s = MARK.search(end), TAIL.search(end)
        if not (m and m.start() == 0 or s and s.start() == 0):
            return end
        n *= 2
    return t


def unmarked(text: str) -> str | None:
    """The text without a mark of a cut and blanks behind it; null where there is no mark, or nothing else."""
    t = text.rstrip()
    if not MARK_END.search(t[-9:]):
        return None
    end = tail_of(t)
    m = MARK.search(end)
    if not m:
        return None
    return t[: len(t) - len(end) + m.start()].rstrip() or None


def judge(text: str) -> int:
    """0: complete; 1: cut; 2: complete or cut, a longer copy decides."""
    t = text.rstrip()
    if not t:
        return 0
    if t[-1] in ".!?" and t[-2:] != "..":
        return 0
    t = tail_of(t)
    if BROKEN.search(t) and not CLOSED.search(t):
        return 1
    marked = MARK.search(t)
    if marked and marked.start() == 0:
        return 0
    core = t[: marked.start()].rstrip() if marked else t
    if marked:
        if BROKEN.search(core):
            return 1
        bare = TAIL.sub("", core) or core
        # dots of style behind a complete sentence; the first of four or more is its stop
        return 0 if marked.group().startswith("....") or CLOSED.search(core) or ENDINGS.search(bare) or VERB.search(bare) else 1
    if CLOSED.search(t):
        return 0
    sign = TAIL.search(t)
    bare = TAIL.sub("", t)
    if sign and (not bare or CLOSED.search(bare) or VERB.search(bare) or sign.group().strip()[:1] in (".", "!", "…")):
        return 0
    if ENDINGS.search(t) or ENDINGS.search(bare):
        return 0
    return 2 if VERB.search(bare) else 1


def prefix_hashes(text: str) -> list[int]:
    """Hashes of the prefixes of 1, 2, 4, 8, ... characters, up to the whole text."""
    import xxhash

    h, out, at, n = xxhash.xxh3_64(), [], 0, 1
    while n <= len(text):
        h.update(text[at:n].encode("utf-8", "surrogatepass"))
        out.append(h.intdigest() - (1 << 63))
        at, n = n, 2 * n
    return out


def _whole(text: str) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


LOOKS = "id long, source string, verdict int, whole binary, keys array<long>, look array<struct<key:long,n:int,whole:binary>>"


def _looks(batches):
    """(id, source, text) -> LOOKS: how a text ends, the hashes of its prefixes, and what it looks up."""
    for batch in batches:
        verdicts, wholes, keys, looks = [], [], [], []
        for x in batch.column(2).to_pylist():
            x = x or ""
            t = x.rstrip()
            h = prefix_hashes(x)
            verdicts.append(judge(x))
            wholes.append(_whole(x))
            keys.append(h)
            found = []
            for y in (t, unmarked(x) if t else None):
                if y:
                    found.append({"key": h[len(y).bit_length() - 1], "n": len(y), "whole": _whole(y)})
            looks.append(found)
        look = pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int32()), ("whole", pa.binary())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(verdicts, pa.int32()), pa.array(wholes, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(looks, look)], [c.split()[0] for c in LOOKS.split(", ")[:5]] + ["look"])


def _beginnings(batches):
    """(text, lengths) -> (whole, goes_on): hashes of the beginnings of the text without mark, and whether its word goes on behind them."""
    for batch in batches:
        wholes, on = [], []
        for x, lengths in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            end = len(unmarked(x) or x.rstrip())
            for n in lengths:
                if n < end:
                    wholes.append(_whole(x[:n]))
                    on.append(not x[n].isspace())
        yield pa.RecordBatch.from_arrays([pa.array(wholes, pa.binary()), pa.array(on, pa.bool_())], ["whole", "goes_on"])


def longer_copies(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, goes_on): texts that are, with or without a mark, the beginning of a longer one. rows: LOOKS of docs (id, text)."""
    look = rows.select("id", F.explode("look").alias("x")).select("id", "x.key", "x.n", "x.whole")
    # at most as many lengths as the prefix has characters
    lengths = look.groupBy("key").agg(F.collect_set("n").alias("lengths"), F.min("n").alias("least"))
    texts = rows.groupBy("whole").agg(F.min_by("keys", "id").alias("keys"), F.min("id").alias("id"))
    mine = texts.select("id", F.explode("keys").alias("key"))
    could = mine.join(lengths.hint("merge"), "key").groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("lengths"))).alias("lengths"))
    # most texts only meet themselves: those need no second look
    sizes = docs.select("id", F.length("text").alias("size"))
    could = could.join(sizes, "id").withColumn("lengths", F.filter("lengths", lambda n: n < F.col("size"))).where("size(lengths) > 0").drop("size")
    begun = docs.join(could.hint("merge"), "id").select("text", "lengths").mapInArrow(_beginnings, "whole binary, goes_on boolean")
    begun = begun.groupBy("whole").agg(F.bool_or("goes_on").alias("goes_on"))
    return look.join(begun.hint("merge"), "whole").groupBy("id").agg(F.bool_or("goes_on").alias("goes_on"))


def verdicts(docs: DataFrame) -> DataFrame:
    """(id, source, cut): docs is (id, source, text)."""
    d = docs.select(F.col("id").cast("long").alias("id"), F.col("source").cast("string").alias("source"), "text")
    rows = cut(d.mapInArrow(_looks, LOOKS))
    found = longer_copies(rows, d.where("text <> ''").select("id", "text"))
    j = rows.select("id", "source", "verdict").join(found, "id", "left")
    return j.select("id", "source", ((F.col("verdict") == 1) | (F.col("goes_on").isNotNull() & (F.coalesce("goes_on", F.lit(False)) | (F.col("verdict") == 2)))).alias("cut"))


def rates(v: DataFrame) -> DataFrame:
    """(source, texts, cut_texts, rate) of verdicts."""
    return v.groupBy("source").agg(F.count("*").alias("texts"), F.sum(F.col("cut").cast("long")).alias("cut_texts")).withColumn("rate", F.col("cut_texts") / F.col("texts"))
