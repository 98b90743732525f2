"""Main body of pages by wrapper induction.

Pages arrive as text lines, so a page's tree is rebuilt from its layout: the page, its blocks (runs of lines between
blank lines), their lines, and the items of lines that are divided by signs. No list of words is used; what is
template and what is content follows from the pages themselves:

1. *Nodes.* Each line becomes a label: lower case, single blanks, digits, mails, the outlet's name and its host as slots.
   A line without a sentence end also has the labels of its first one to three words, for lines that are constant at
   their beginning only, and of its signs, for lines such as rows of tags. Labels are counted over all pages of a
   host, and over all hosts. Copies of one body don't make it constant: a label counts for the different longest
   lines of its pages, and a sentence must stand on a hundredth of its host's pages or on five hosts.
2. *Alignment.* The trees of pages of a host are aligned pairwise by simple tree matching (the largest match of equal
   nodes that keeps order, by dynamic programming over blocks and over their lines). Matched nodes say where they
   stand to what varies: outside all varying sentences, or between them, and whether a slot of varying titles follows.
   These votes are summed by label over all pairs.
3. *Template.* A constant node is template if it stands outside the varying sentences in most alignments, or if it has
   a slot of its site. Constant nodes between sentences are subheads and stay. A node that is followed by titles in
   most alignments heads a list of links; its items are template too. Everything else is content.

Pages are brought together by host; a host of more than PAGES pages is split by a hash of the id, whose parts only
decide which pages are aligned with which: counts and votes are summed over all parts. Hosts of one page have the
labels that are constant over hosts.

Null contents have no lines; a null host is an outlet of its own, a null name is that of most other pages of the host.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cribble.operators.lineage import cut

#: Pages of one part of a host; pages that each page is aligned with.
PAGES, NEIGHBOURS = 512, 2
#: Different bodies, or hosts, that make a label constant; hosts that make a sentence constant; its share of a host's pages.
SUPPORT, SENTENCE_HOSTS, SENTENCE_SHARE = 3, 5, 0.01
#: Lines with a beginning that make it one, and the share of them without a sentence end.
BEGINNINGS, PURE = 8, 0.95
#: There are fewer than HOT hosts with more than a HOT-th of all pages.
HOT = 5000

#: The end of a sentence; a title may end in ? too.
SENTENCE = re.compile(r"(?:[.!…]|[다요죠까]\?|나요\?)[\"'”’)\]]*$|(?:[.!?…])[\"'”’)]+$")
MAIL = re.compile(r"[\w.+-]+@[\w.-]+\.\w+")
DIGITS = re.compile(r"[0-9]+")
ITEMS = re.compile(r"\s*[|·>/›»]\s*")
WORDS = re.compile(r"\w+")
SLOTS = ("<n>", "<m>", "<d>")
#: Bits of a line: it ends like a sentence, it holds a slot of the site, it begins a block, it is the page's longest (the next two bits: the second and third).
IS_SENTENCE, IS_SITE, IS_BLOCK, IS_LONGEST = 1, 2, 4, 8
#: Bits of a template row: constant, outside the varying sentences, heads a list, a constant beginning, constant signs.
CONSTANT, EDGE, HEAD, BEGINS, SIGNS = 1, 2, 4, 8, 16


def label(line: str, name: str, host: str) -> str:
    """A line as a node label: lower case, one blank, digits as 0, the outlet's name as <n>, mails as <m>, the host as <d>."""
    s = " ".join(line.split()).lower()
    if name and name in s:
        s = s.replace(name, "<n>")
    if "@" in s:
        s = MAIL.sub("<m>", s)
    if host and host in s:
        s = s.replace(host, "<d>")
    return DIGITS.sub("0", s)


def signs(words: list[str]) -> str | None:
    """The signs of a line all of whose words have some, repetitions left out."""
    out: list[str] = []
    for w in words:
        z = WORDS.sub("w", w)
        if z == "w":
            return None
        if not out or out[-1] != z:
            out.append(z)
    return " ".join(out)


def match_lines(a: list, b: list) -> list[tuple[int, int]]:
    """Positions of the longest common subsequence of two blocks."""
    if not set(a) & set(b):
        return []
    n = len(b) + 1
    best = [[0] * n for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        row, up = best[i + 1], best[i]
        for j, y in enumerate(b):
            row[j + 1] = up[j] + 1 if x == y else max(up[j + 1], row[j])
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif best[i - 1][j] >= best[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def match_trees(a: list[list], b: list[list]) -> list[tuple[int, int, int, int]]:
    """Simple tree matching of two pages of blocks: (block, line, block, line) of the matched nodes."""
    if not a or not b:
        return []
    kids = {(i, j): m for i, x in enumerate(a) for j, y in enumerate(b) if (m := match_lines(x, y))}
    if not kids:
        return []
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = max(best[i][j] + len(kids.get((i, j), ())), best[i][j + 1], best[i + 1][j])
    out, i, j = [], len(a), len(b)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out += [(i, x, j, y) for x, y in kids.get((i, j), ())]
    return out


TREES = "id long, host string, sigs array<int>, nos array<int>, flags array<int>, whole array<long>, forms array<long>, items array<array<long>>"


def _trees(batches):
    """(id, host, name, content) -> TREES: the non-blank lines of each page with the hashes of their labels."""
    import xxhash

    known: dict = {}

    def h(kind: str, s: str) -> int:
        return xxhash.xxh3_64_intdigest((kind + s).encode("utf-8", "surrogatepass")) - (1 << 63)

    def line(y: str) -> tuple:
        v = known.get(y)
        if v is None:
            flag = (IS_SENTENCE if SENTENCE.search(y) else 0) | (IS_SITE if any(x in y for x in SLOTS) else 0)
            w = y.split(" ")
            forms = [h("^", " ".join(w[:k])) if len(w) > k else 0 for k in (1, 2, 3)]
            sign = None if flag & IS_SENTENCE else signs(w)
            parts = [] if flag & IS_SENTENCE else [x for x in ITEMS.split(y) if x]
            if len(known) > 200_000:
                known.clear()
            v = known[y] = (flag, h("=", y), [*forms, h("#", sign) if sign else 0], [h("=", x) for x in parts] if len(parts) > 1 else [])
        return v

    for batch in batches:
        rows: list = [[] for _ in range(8)]
        for i, host, name, content in zip(*(batch.column(k).to_pylist() for k in range(4))):
            nos, flags, whole, forms, items = [], [], [], [], []
            lengths, block = [], IS_BLOCK
            for no, raw in enumerate(content.split("\n")):
                y = label(raw, name.lower(), host)
                if not y:
                    block = IS_BLOCK
                    continue
                flag, w, f, x = line(y)
                lengths.append(-len(y))
                nos.append(no), flags.append(flag | block), whole.append(w), items.append(x)
                forms += f
                block = 0
            # the page's three longest lines stand for its body, each as one of 64 bits
            order = sorted(range(len(nos)), key=lambda k: (lengths[k], k))[:3]
            for rank, k in enumerate(order):
                flags[k] |= IS_LONGEST << rank
            sigs = [whole[k] % 64 for k in order] + [0] * (3 - len(order))
            for col, v in zip(rows, (i, host, sigs, nos, flags, whole, forms, items)):
                col.append(v)
        kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], [c.split()[0] for c in TREES.split(", ")])


def named(docs: DataFrame) -> DataFrame:
    """docs with the name of most pages of the host where a page has none."""
    have = docs.where("name is not null and name <> ''")
    none = docs.where("name is null or name = ''")
    most = have.groupBy("host", "name").agg(F.count("*").alias("n")).groupBy("host").agg(F.max_by("name", F.struct("n", "name")).alias("most"))
    # a host may hold a third of all rows: its pages are spread over 64 copies of its name
    most = most.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(63))))
    none = none.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)).cast("int")).join(most.hint("merge"), ["host", "part"], "left")
    cols = ["id", "host", "name", "content"]
    return have.select(*cols).unionByName(none.select("id", "host", F.coalesce("most", F.lit("")).alias("name"), "content"))


def constants(trees: DataFrame, sizes: DataFrame) -> DataFrame:
    """(host, form, bits): labels that are constant on a host or over hosts, whole ones and beginnings and signs."""
    every = (
        "inline(flatten(transform(sequence(0, size(whole) - 1), i -> concat(array(struct(whole[i] as form, 0 as kind, flags[i] as flag)), "
        "transform(slice(forms, 4 * i + 1, 3), f -> struct(f as form, 1 as kind, flags[i] as flag)), array(struct(forms[4 * i + 3] as form, 2 as kind, flags[i] as flag)), "
        "transform(items[i], f -> struct(f as form, 0 as kind, flags[i] as flag))))))"
    )
    rows = trees.where("size(whole) > 0").select("host", "sigs", F.expr(every)).where("form <> 0")
    title = F.col("flag").bitwiseAND(IS_SENTENCE) == 0
    # a beginning counts for its lines of either end, but only titles make it constant
    counts = (F.col("kind") == 0) | title
    body = lambda r: F.bit_or(F.when(counts & (F.col("flag").bitwiseAND(IS_LONGEST << r) == 0), F.expr(f"shiftleft(1L, sigs[{r}])")).otherwise(F.lit(0).cast("long")))
    n = rows.groupBy("form", "host", "kind").agg(F.count("*").alias("n"), F.count_if(title).alias("titles"), *[body(r).alias(f"b{r}") for r in range(3)])
    # different bodies: by the kind of line that tells most of them apart; a sentence needs two kinds
    several = F.array_sort(F.array(*[F.bit_count(f"b{r}") for r in range(3)]))
    n = cut(n.select("form", "host", "kind", "n", "titles", F.when((F.col("kind") == 0) & (F.col("titles") == 0), several[1]).otherwise(several[2]).alias("bodies")))
    g = n.groupBy("form").agg(F.sum("n").alias("lines"), F.sum("titles").alias("all_titles"), F.count_if(F.col("bodies") > 0).alias("hosts"), F.max("bodies").alias("most"))
    g = g.where((F.col("lines") >= SUPPORT) & ((F.col("hosts") >= SUPPORT) | (F.col("most") >= SUPPORT)))
    j = n.join(g.hint("merge"), "form")
    often = (F.col("bodies") >= SUPPORT) | (F.col("hosts") >= SUPPORT)
    sentence = (F.col("kind") == 0) & (F.col("titles") == 0)
    j = j.where(often).where(~sentence | (F.col("hosts") >= SENTENCE_HOSTS) | (F.col("bodies") >= SUPPORT))
    j = j.join(sizes.hint("merge"), "host").where(~sentence | (F.col("hosts") >= SENTENCE_HOSTS) | (F.col("n") >= F.greatest(F.lit(SUPPORT), F.floor(F.col("pages") * SENTENCE_SHARE))))
    pure = (F.col("all_titles") > PURE * F.col("lines")) & (F.col("all_titles") >= BEGINNINGS)
    bits = F.when(F.col("kind") == 0, CONSTANT).when(pure & (F.col("kind") == 1), BEGINS).when(pure, SIGNS)
    return j.select("host", "form", bits.alias("bits"), "parts").where("bits is not null")


def _placed(left: pa.Table, right: pa.Table, columns: list[str]):
    """Pages by (host, part) in order of the hash of their ids, and the template rows of each host."""
    known: dict = {}
    for host, form, *values in zip(*(right.column(c).to_pylist() for c in ["host", "form", *columns])):
        known.setdefault(host, {})[form] = values[0] if len(values) == 1 else values
    runs: dict = {}
    cols = [left.column(c).to_pylist() for c in ("host", "part", "spread", "id", "nos", "flags", "whole", "forms", "items")]
    for row in zip(*cols):
        runs.setdefault((row[0], row[1]), []).append(row[2:])
    for (host, _), pages in sorted(runs.items()):
        pages.sort(key=lambda p: (p[0], p[1]))
        yield pages, known.get(host, {})


VOTES = "form long, aligned long, edge long, follow long, titles long, alone long, alone_edge long, alone_follow long, alone_titles long"


def _votes(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Aligns each page with its neighbours; sums by label where the matched nodes stand and what follows them."""
    votes: dict = {}

    def add(form: int, at: int, edge: bool, follow: bool, titles: bool) -> None:
        v = votes.get(form)
        if v is None:
            v = votes[form] = [0] * 8
        v[at] += 1
        v[at + 1] += edge
        v[at + 2] += follow
        v[at + 3] += titles

    for pages, known in _placed(left, right, ["bits"]):
        views = []
        for _, _, _, flags, whole, forms, _ in pages:
            const = [known.get(w, 0) & CONSTANT for w in whole]
            text = [f & IS_SENTENCE and not c for f, c in zip(flags, const)]
            first = next((k for k, t in enumerate(text) if t), len(text))
            last = max((k for k, t in enumerate(text) if t), default=-1)
            tree: list[list] = []
            where: list[list] = []
            for k, w in enumerate(whole):
                if not tree or flags[k] & IS_BLOCK:
                    tree.append([]), where.append([])
                edge = not first < k < last
                title = k + 1 < len(whole) and not const[k + 1] and not flags[k + 1] & IS_SENTENCE
                if const[k]:
                    tree[-1].append(w), where[-1].append((edge, k + 1 < len(whole), title))
                    add(w, 4, edge, k + 1 < len(whole), title)
                if (s := forms[4 * k + 3]) and known.get(s, 0) & SIGNS:
                    add(s, 4, edge, False, False)
            views.append((tree, where))
        n = len(views)
        for i in range(n):
            for k in range(1, min(NEIGHBOURS, n - 1) + 1):
                (ta, wa), (tb, wb) = views[i], views[(i + k) % n]
                for p, x, q, y in match_trees(ta, tb):
                    a, b = wa[p][x], wb[q][y]
                    add(ta[p][x], 0, a[0] and b[0], a[1] and b[1], a[2] and b[2])
    cols = [list(votes), *([v[k] for v in votes.values()] for k in range(8))]
    return pa.table([pa.array(c, pa.int64()) for c in cols], names=[c.split()[0] for c in VOTES.split(", ")])


def _outside(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """(id, line_no) of the lines that the template of the host covers."""
    ids, nos = [], []
    for pages, known in _placed(left, right, ["bits"]):
        for _, i, lines, flags, whole, forms, items in pages:
            out = set()
            const = [known.get(w, 0) for w in whole]
            soft = set()
            for k, b in enumerate(const):
                if b & CONSTANT:
                    if b & EDGE or flags[k] & IS_SITE:
                        out.add(k)
                elif not flags[k] & IS_SENTENCE:
                    if items[k] and all(known.get(x, 0) & CONSTANT for x in items[k]) or known.get(forms[4 * k + 3], 0) & SIGNS and known[forms[4 * k + 3]] & EDGE:
                        out.add(k)
                    elif any(known.get(f, 0) & BEGINS for f in forms[4 * k : 4 * k + 3] if f):
                        out.add(k), soft.add(k)
            for k, b in enumerate(const):
                if b & HEAD and k in out and not flags[k] & IS_SENTENCE:
                    for x in range(k + 1, len(const)):
                        if flags[x] & IS_SENTENCE or const[x] & CONSTANT or x in out and x not in soft:
                            break
                        out.add(x), soft.add(x)
            ids += [i] * len(out)
            nos += [lines[k] for k in sorted(out)]
    return pa.table([pa.array(ids, pa.int64()), pa.array(nos, pa.int32())], names=["id", "line_no"])


def furniture(docs: DataFrame) -> DataFrame:
    """(id, line_no): non-blank lines that are not main body. docs: id, host, name (of the outlet), content."""
    d = docs.where("content is not null").select(F.col("id").cast("long").alias("id"), F.coalesce(F.col("host").cast("string"), F.lit("")).alias("host"), F.col("name").cast("string").alias("name"), "content")
    trees = cut(named(d).mapInArrow(_trees, TREES))
    sizes = cut(trees.groupBy("host").agg(F.count("*").alias("pages")).withColumn("parts", F.ceil(F.col("pages") / PAGES).cast("int")))
    total = sizes.agg(F.sum("pages")).first()[0] or 0
    groups = total // PAGES + 1
    spread = F.xxhash64("id")
    # hosts of several parts: those above a HOT-th of all pages are fewer than HOT; others exist only in large tables
    bound = max(PAGES, total // HOT)
    large = sizes.where(F.col("parts") > 1).select("host", "parts")
    pages = trees.withColumn("spread", spread)
    many = pages.join(F.broadcast(sizes.where(F.col("pages") > bound).select("host", "parts")), "host", "left")
    if bound > PAGES:
        some = large.join(sizes.where(F.col("pages") <= bound).select("host"), "host").withColumnRenamed("parts", "some")
        many = many.join(some.hint("merge"), "host", "left").withColumn("parts", F.coalesce("parts", "some")).drop("some")
    group = F.pmod(F.xxhash64("host", "part"), F.lit(groups)).alias("g")
    pages = many.withColumn("part", F.coalesce(F.pmod("spread", F.col("parts").cast("long")).cast("int"), F.lit(0)))
    pages = pages.where("size(whole) > 0").select(group, *[F.col(c).alias(c) for c in ("host", "part", "spread", "id", "nos", "flags", "whole", "forms", "items")])
    const = cut(constants(trees, sizes))
    spots = lambda t: t.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(group, F.col("host").alias("host"), F.col("form").alias("form"), F.col("bits").alias("bits"))
    # so many tasks, whatever the bytes: the work is Python's
    place = lambda t: t.repartition(int(groups), "g").groupBy("g")
    votes = place(pages).cogroup(place(spots(const))).applyInArrow(_votes, VOTES)
    names = [c.split()[0] for c in VOTES.split(", ")][1:]
    v = votes.groupBy("form").agg(*[F.sum(c).alias(c) for c in names])
    # labels that no alignment matched are judged by where they stand on their own pages
    pick = lambda a, b: F.when(F.col("aligned") > 0, F.col(a)).otherwise(F.col(b))
    edge = pick("edge", "alone_edge") > 0.5 * pick("aligned", "alone")
    head = (pick("follow", "alone_follow") > 0) & (pick("titles", "alone_titles") > 0.5 * pick("follow", "alone_follow"))
    v = v.select("form", (F.when(edge, EDGE).otherwise(0) + F.when(head, HEAD).otherwise(0)).alias("more"))
    template = const.join(v.hint("merge"), "form", "left").withColumn("bits", F.col("bits") + F.coalesce("more", F.lit(0)))
    return place(pages).cogroup(place(spots(template))).applyInArrow(_outside, "id long, line_no int")


def main_body(docs: DataFrame) -> DataFrame:
    """(id, content): each content without the lines outside its body."""
    bad = furniture(docs).groupBy("id").agg(F.collect_set("line_no").alias("bad"))
    lines = F.filter(F.split("content", "\n"), lambda x, i: ~F.array_contains(F.coalesce(F.col("bad"), F.array().cast("array<int>")), i))
    return docs.join(bad, "id", "left").select("id", F.array_join(lines, "\n").alias("content"))
