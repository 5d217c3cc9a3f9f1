"""Main-text extraction by site template removal.

1. ``parse``: each page becomes its text segments in page order. A segment knows the container elements it stands in,
   as hashes of their subtrees: by shape (tags and classes) and text. Outside an article link texts and numbers count as
   equal, so that a site's lists of links recur though their entries change; text of mostly digits counts as it is.
2. Spark counts, per host, on how many pages (copies of one article being one) each subtree hash occurs and which
   share of a page's text it holds on average. Subtrees that recur on a fifth of the host's pages (at least four) and
   hold the smaller part of them are templates.
3. Segments inside a template go, wherever they stand. Of the rest go nav, footer, aside and the like, then the boxes
   whose class, id or tag says that they are no article (form, ads, comments, ...), which also covers hosts with too
   few pages to count. Such a name does not count for a box that holds a main element, an article (unless the name is
   one of ``OTHERS``, whose articles are teasers or comments) or most of the page's text that is left (if the name is a
   whole one, as in class="ad", only on pages without an article).
4. Where articles and main elements hold most of what is left, only what is inside them stays; else all of it.

Paragraphs, headings and inline elements are never templates, so a passage that many pages quote stays.

Defined cases: null, empty and text-only html give the text there is (null: empty). Unclosed elements end with their
parent; an end tag without a start is ignored; script, style and the like are skipped up to their end tag or the end of
the page. Pages without a host share the empty host. Repeated rows give repeated results and count as one page. Extra
columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import WorkTables, own_columns, table

MIN_PAGES, MIN_SHARE, MOST_TEXT = 4, 0.2, 0.5
#: Templates up to this size, in lists per host up to this length, go to every executor; others are joined by page, with the same result.
BROADCAST_BYTES, HOST_TEMPLATES = 32 << 20, 10_000

#: Element names of HTML by their role.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "select", "option", "button", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "dt", "dd", "td", "th", "tr", "caption", "figcaption"}
BOXES = {"html", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "figure", "fieldset", "details", "dialog", "address", "menu", "center"}
MAIN = {"article", "main"}
NEVER = {"nav", "footer", "aside", "menu", "dialog", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu"}
#: Words of class and id names that mark what is no article.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|popup|modal|newsletter|subscribe|nav\w*|menu|breadcrumbs?|sidebar|side|footer|masthead|"
    r"site-?header|comments?|disqus|replies|respond|share|sharing|social|related|recommended|widget|pagination|pager|skip)(?:$|[\s_-])"
)
#: Of these, the words for other content: an article in such a box is a teaser or a comment.
OTHERS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|disqus|replies|respond|related|recommended)(?:$|[\s_-])")

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""", re.S)
BLANKS = re.compile(r"[ \t\r\n]+")
DIGITS = re.compile(r"\d+")
#: Stands for a link's text.
LINK = "\x00"
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class _Box:
    """An open container: what its subtree hashes are made of."""

    __slots__ = ("chars", "children", "classes", "dropped", "inside", "main", "marked", "number", "others", "parts", "plain", "tag")

    def __init__(self, tag: str, classes: str, inside: bool, dropped: bool, number: int, main: bool = False, marked: bool = False, others: bool = False, plain: bool = False):
        self.tag, self.classes, self.inside, self.dropped, self.number = tag, classes, inside, dropped, number
        self.main, self.marked, self.others, self.plain = main, marked, others, plain
        self.children: list[int] = []
        self.parts: list[str] = []
        self.chars = 0


def _wording(parts: list[str]) -> str:
    """A box's own text outside articles as its hash sees it: links in a row are one, and numbers equal."""
    words: list[str] = []
    for word in "".join(parts).split():
        if word.strip(LINK):
            words.append(word)
        elif not words or words[-1] != LINK:
            words.append(LINK)
    text = " ".join(words)
    if sum(map(str.isdigit, text)) > sum(map(str.isalpha, text)):
        return text
    return DIGITS.sub("0", text)


def parse(page: str) -> tuple[list[tuple[list[int], list[int], list[int], bool, bool, str]], list[tuple[int, int]], int, int]:
    """A page's segments (box numbers, those of them named as no article in part and by a whole name, inside an article, dropped, text), each box's (hash, characters), all characters, the main article's hash (else the page's)."""
    import xxhash

    name = xxhash.xxh3_64_intdigest
    root = _Box("", "", False, False, -1)
    stack: list[tuple[str, _Box | None]] = [("", root)]
    boxes, boxed, mains, links = [root], [], [], 0
    named: set[int] = set()
    plain: set[int] = set()
    segments: list[tuple[list[int], bool, bool, list[str]]] = [([], False, False, [])]

    def settle() -> None:
        top = boxes[-1]
        segments.append(([b.number for b in boxes[1:]], top.inside, top.dropped, [" "]))

    def close() -> None:
        nonlocal links
        tag, box = stack.pop()
        if box is None:
            links -= tag == "a"
            if tag in PROSE:
                segments[-1][3].append(" ")
            return
        boxes.pop()
        shape = f"{box.tag}.{box.classes}({','.join(map(str, dict.fromkeys(box.children)))})"
        shape += " ".join("".join(box.parts).split()) if box.inside else _wording(box.parts)
        digest = name(shape.encode())
        boxed[box.number] = (digest, box.chars)
        if box.main and not box.dropped:
            mains.append((box.chars, digest, box.number))
        if box.marked:
            (plain if box.plain else named).add(box.number)
        boxes[-1].children.append(digest)
        boxes[-1].chars += box.chars
        if boxes[-1].inside:
            boxes[-1].parts += box.parts
        settle()

    def say(text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        segments[-1][3].append(text)
        top = boxes[-1]
        top.chars += len(text) if text.strip() else 0
        top.parts.append(f" {LINK} " if links and not top.inside and text.strip() else text)

    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        if found.start() > at:
            say(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            if any(t == tag for t, _ in stack[1:]):
                while stack[-1][0] != tag:
                    close()
                close()
            continue
        attributes = found[3] or found[6] or ""
        if tag in RAW:
            if not attributes.endswith("/"):
                closing = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = closing.end() if closing else end
            segments[-1][3].append(" ")
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                segments[-1][3].append(" ")
                boxes[-1].parts.append(" ")
            continue
        if tag in PROSE or tag in BOXES:
            ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ("p", "h1", "h2", "h3", "h4", "h5", "h6"))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][1] is not None:
                    break
                if stack[depth][0] in ends:
                    while len(stack) > depth:
                        close()
                    break
        if tag in BOXES:
            names = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in NAMES.finditer(attributes)} if attributes else {}
            above = boxes[-1]
            names_of = f"{names.get('class', '')} {names.get('id', '')}"
            main = tag in MAIN or names.get("role") == "main"
            never = tag in NEVER or names.get("role") in ROLES
            marked = tag != "body" and (bool(MARKS.search(names_of)) or tag == "form" or names.get("role") == "form" or (tag == "header" and not above.inside))
            whole = tag in ("form", "header") or any(MARKS.fullmatch(w) for w in names_of.split())
            box = _Box(tag, names.get("class", ""), above.inside or main, above.dropped or (never and tag != "body"), len(boxed), main, marked, bool(OTHERS.search(names_of)), whole)
            if main and not box.dropped:
                sure = tag == "main" or names.get("role") == "main"
                # Names of the layout mean nothing on these. An article that is a comment or teaser frees no box around it.
                box.marked = box.others and not sure
                for outer in boxes if not box.marked else ():
                    outer.marked = outer.marked and not sure and (outer.others or outer.main)
            boxed.append((0, 0))
            stack.append((tag, box))
            boxes.append(box)
            settle()
        else:
            stack.append((tag, None))
            links += tag == "a"
            if tag in PROSE:
                segments[-1][3].append(" ")
                boxes[-1].parts.append(" ")
                boxes[-1].children.append(name(tag.encode()))
    while len(stack) > 1:
        close()
    texts = [(path, [i for i in path if i in named], [i for i in path if i in plain], inside, dropped, text) for path, inside, dropped, parts in segments if not (text := "".join(parts)).isspace() and text]
    # Copies are told by the largest article, if it holds most of the text that can be main text.
    chars, digest, number = max(mains, key=lambda m: m[0], default=(0, 0, -1))
    free = [t for t in texts if not (t[1] or t[2] or t[4])]
    live, held = sum(len(t[5]) for t in free), sum(len(t[5]) for t in free if number in t[0])
    return texts, boxed, root.chars, digest if 2 * held > live else name(page.encode())


_SEGMENT = pa.struct([("path", pa.list_(pa.int32())), ("named", pa.list_(pa.int32())), ("plain", pa.list_(pa.int32())), ("inside", pa.bool_()), ("text", pa.string())])
_BOXES = pa.list_(pa.struct([("hash", pa.int64()), ("share", pa.float64())]))


def _candidates(found: list[tuple[list[int], list[int], list[int], bool, bool, str]]) -> list[tuple[list[int], list[int], list[int], bool, str]]:
    """The segments that can be main text: all outside nav, footer and the like.

    Neighbours in the same boxes are one, since they stay or go together; runs of blanks become one.
    """
    out: list[tuple[list[int], list[int], list[int], bool, list[str]]] = []
    for path, named, plain, inside, dropped, text in found:
        if dropped:
            continue
        if out and out[-1][0] == path:
            out[-1][4].append(text)
        else:
            out.append((path, named, plain, inside, [text]))
    return [(*rest, BLANKS.sub(" ", "".join(texts))) for *rest, texts in out]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    signed = lambda x: x - (x >> 63 << 64)
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            segments, owns, boxes, copies = [], [], [], []
            for page in batch.column(3).to_pylist():
                found, boxed, chars, copy = parse(page or "")
                copies.append(signed(copy))
                # A segment names its boxes by their place in the page's list of hashes.
                own: dict[int, int] = {}
                place = lambda numbers: sorted({own.setdefault(signed(boxed[i][0]), len(own)) for i in numbers})  # noqa: E731, B023
                segments.append([{"path": place(path), "named": place(named), "plain": place(plain), "inside": inside, "text": text} for path, named, plain, inside, text in _candidates(found)])
                owns.append(list(own))
                # A hash that occurs several times on a page counts once, with all its text.
                total: dict[int, float] = {}
                for digest, inner in boxed:
                    total[digest] = total.get(digest, 0.0) + inner / max(chars, 1)
                boxes.append([{"hash": signed(k), "share": min(v, 1.0)} for k, v in total.items()])
            columns = [pa.array(copies, pa.int64()), pa.array(segments, pa.list_(_SEGMENT)), pa.array(owns, pa.list_(pa.int64())), pa.array(boxes, _BOXES)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["page_id", "url", "page", "copy", "segments", "own", "boxes"])


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, text, n_chars) of each page row."""
    work = WorkTables(pages.sparkSession)
    rows = own_columns(pages, "page_id", "url", "html").select("page_id", "url", F.xxhash64("page_id", "url", "html").alias("page"), "html")
    shape = "page_id long, url string, page long, copy long, segments array<struct<path:array<int>,named:array<int>,plain:array<int>,inside:boolean,text:string>>, own array<long>, boxes array<struct<hash:long,share:double>>"
    parsed = work.put(rows.mapInArrow(_parsed, shape), "parsed", compression="zstd")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1))
    seen = parsed.select(host.alias("host"), "page", "copy", "boxes", "own")
    # Copies of one article on a host are one page to the counts, else they would make a template of it.
    single = seen.dropDuplicates(["host", "copy"])
    sizes = single.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    counts = single.select("host", F.inline("boxes")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages"), F.avg("share").alias("share"))
    many = F.greatest(F.lit(MIN_PAGES), F.ceil(F.col("host_pages") * MIN_SHARE))
    templates = counts.filter((F.col("pages") >= MIN_PAGES) & (F.col("share") < MOST_TEXT)).join(sizes, "host").filter(F.col("pages") >= many).select("host", "hash")
    templates = work.put(templates, "templates")
    texts = parsed.select("page_id", "url", "page", "segments", "own", host.alias("host"))
    if _fits(templates, broadcast_bytes):
        # No text is shuffled.
        joined = texts.join(F.broadcast(templates.groupBy("host").agg(F.collect_list("hash").alias("templates"))), "host", "left")
    else:
        used = seen.select("host", "page", F.explode("own").alias("hash")).distinct()
        joined = texts.join(used.join(templates, ["host", "hash"]).groupBy("page").agg(F.collect_set("hash").alias("templates")), "page", "left")
    known = F.array_intersect("own", F.coalesce("templates", F.array().cast("array<bigint>")))
    chosen = joined.select("page_id", "url", "segments", "own", known.alias("known")).mapInArrow(_chosen, "page_id long, url string, text string")
    text = F.trim(F.regexp_replace("text", r"(?U)\s+", " "))
    return chosen.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def _fits(templates: DataFrame, most_bytes: int) -> bool:
    """Whether all templates are small enough to send to every executor: their bytes and the longest list of a host, measured."""
    lists = templates.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    total = lists.agg(F.sum(F.col("n") * 8 + F.octet_length("host") + 64).alias("bytes"), F.max("n").alias("longest")).first()
    return (total["bytes"] or 0) <= most_bytes and (total["longest"] or 0) <= HOST_TEMPLATES


def main_text(segments: list[dict], templates: set[int]) -> str:
    """The text of the kept segments of a page; ``templates`` are places in its list of hashes."""
    good = [s for s in segments if templates.isdisjoint(s["path"])]
    if not good:
        # An article that the counting took for a template is still an article.
        return "".join(s["text"] for s in segments if s["inside"] and not (s["named"] or s["plain"]))
    held: dict[int, int] = {}
    for s in good:
        for i in s["named"] + s["plain"]:
            held[i] = held.get(i, 0) + len(s["text"])
    total = sum(len(s["text"]) for s in good)
    article = any(s["inside"] and not (s["named"] or s["plain"]) for s in good)
    live = [s for s in good if all(2 * held[i] > total for i in s["named"] + s["plain"]) and not (article and s["plain"])]
    inside = [s for s in live if s["inside"]]
    most = 2 * sum(len(s["text"]) for s in inside) > sum(len(s["text"]) for s in live)
    return "".join(s["text"] for s in (inside if most else live))


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            texts = []
            for segments, own, known in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                known = set(known)
                texts.append(main_text(segments, {i for i, digest in enumerate(own) if digest in known}))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
