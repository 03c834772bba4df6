"""Main text of web pages: page structure, and a host-wide suffix array for what it leaves open.

Each page becomes blocks of text in page order. Blocks inside an article or main element are its
content; blocks inside menus, headers, footers, asides, forms, adverts, notices, comments and the
like are not. Pages without such an element leave their blocks open. The token streams of all
blocks that are not known content are joined per host. A substring of RUN tokens or more that
starts in two distinct pages of the host is repeated, and every token it covers is boilerplate, as
is a shorter block that stands whole on two pages. Open blocks keep their unique runs.

The tokens that repeated substrings of at least RUN tokens cover are those that repeated suffixes
cut to RUN tokens cover: every RUN tokens of a longer repeat repeat too. So suffixes are sorted to
that depth: they meet by host and first RUN tokens, so a host with a third of all pages spreads
over as many tasks as it has distinct runs. Counts are combined before they are shuffled, and only
the least and greatest page of a run are kept.
"""

from __future__ import annotations

import html as _html
import json
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import materialize, row_batches

#: Tokens of the shortest repeated run; shorter ones count as whole blocks only.
RUN = 10
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
#: The rest of a tag up to its end: quoted values may hold ">". Possessive, so nothing is tried twice.
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTR = re.compile(r"(?:^|\s)(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|=|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
#: Elements of HTML by how they bear on text.
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas select option datalist audio video map noframes noembed xmp plaintext".split())
CHROME = frozenset("nav footer aside form menu dialog button head".split())
CONTENT = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Words of class, id and role that mark what is not content.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login "
    "comment comments disqus reply replies respond discussion nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside widget widgets related recommended footer masthead header share sharing social toolbar skip pagination pager search complementary contentinfo tags".split()
)
#: Of these, words that also name parts of an article; inside one they mark nothing.
AMBIGUOUS = frozenset("discussion social tags search complementary header promotion".split())
_OPEN, _CONTENT, _CHROME = 0, 1, 2
#: A start tag in the first row ends an open element of the second.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements that the end tag of a paragraph or inline element does not close.
_HOLDS = frozenset("article main div section td".split())
_INLINE = frozenset("p li b i a span".split())
_ENDS_P = BLOCKS - {"body", "html", "caption", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt", "legend", "summary", "figcaption", "head"}


def _kind(tag: str, attrs: str, inside: bool) -> int:
    if tag in CHROME or (tag == "header" and not inside):
        return _CHROME
    if attrs:
        if _HIDDEN.search(attrs):
            return _CHROME
        for m in _ATTR.finditer(attrs):
            words = re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", m[1] or m[2] or m[3] or "").lower())
            if tag not in CONTENT and tag not in ("body", "html") and not (MARKS - AMBIGUOUS if inside else MARKS).isdisjoint(words):
                return _CHROME
            if m[0].strip().lower().startswith("role") and "main" in words:
                return _CONTENT
    return _CONTENT if tag in CONTENT else _OPEN


class _Open:
    """The open elements. Every question is answered without walking them, so a page costs time in
    proportion to its length however deep it nests."""

    def __init__(self):
        self.tags: list[str] = []
        self.kinds: list[int] = []
        self.held: Counter = Counter()
        self.frames: list[Counter] = [Counter()]  # what is open above each of _HOLDS
        self.blocks: list[int] = []  # places of block elements
        self.content = 0

    def kind(self) -> int:
        return self.kinds[-1] if self.kinds else _OPEN

    def push(self, tag: str, kind: int) -> None:
        if tag in BLOCKS:
            self.blocks.append(len(self.tags))
        self.tags.append(tag)
        self.kinds.append(kind)
        self.held[tag] += 1
        self.content += kind == _CONTENT
        if tag in _HOLDS:
            self.frames.append(Counter())
        else:
            self.frames[-1][tag] += 1

    def pop(self) -> str:
        """Close the innermost element."""
        tag = self.tags.pop()
        self.held[tag] -= 1
        self.content -= self.kinds.pop() == _CONTENT
        if tag in _HOLDS:
            self.frames.pop()
        else:
            self.frames[-1][tag] -= 1
        if self.blocks and self.blocks[-1] == len(self.tags):
            self.blocks.pop()
        return tag

    def closes(self, tag: str) -> bool:
        """Whether the end tag closes an open element."""
        return (self.frames[-1] if tag in _INLINE else self.held)[tag] > 0

    def cut(self, at: int) -> None:
        while len(self.tags) > at:
            self.pop()


def blocks(source: str) -> list[tuple[int, str]]:
    """(kind, text) of a page's blocks in page order, of whole html; kind: 0 open, 1 content, 2 neither.

    Character references are decoded, white space is one space, empty blocks go. Unclosed
    elements end with their parent, stray end tags count for nothing. A tag whose quotes never
    close ends at the next ">", as do all tags after it; without one the rest is text.
    """
    out: list[tuple[int, str]] = []
    stack = _Open()
    text: list[str] = []
    kind = _OPEN

    def close() -> None:
        if text:
            own = _SPACE.sub(" ", _html.unescape("".join(text))).strip()
            if own:
                out.append((kind, own))
            text.clear()

    at, n, quotes = 0, len(source), True
    while at < n:
        less = source.find("<", at)
        if less < 0:
            text.append(source[at:])
            break
        if less > at:
            text.append(source[at:less])
        at = less + 1
        if source.startswith("!--", at):
            end = source.find("-->", at + 3)
            at = n if end < 0 else end + 3
            continue
        if source.startswith("![CDATA[", at):
            end = source.find("]]>", at + 8)
            text.append(_html.escape(source[at + 8 : n if end < 0 else end], quote=False))
            at = n if end < 0 else end + 3
            continue
        if source.startswith(("!", "?"), at):
            end = source.find(">", at)
            at = n if end < 0 else end + 1
            continue
        m = _NAME.match(source, at)
        if m is None:
            text.append("<")
            continue
        rest = _REST.match(source, m.end()) if quotes else None
        if rest is None:
            quotes, end = False, source.find(">", m.end())
            if end < 0:
                text.append(source[less:])
                break
            end += 1
        else:
            end = rest.end()
        at, tag, attrs = end, m[2].lower(), source[m.end() : end - 1]
        if m[1]:  # an end tag
            if tag == "br":
                text.append(" ")
            elif stack.closes(tag):
                if tag in BLOCKS:
                    close()
                while stack.pop() != tag:
                    pass
                if stack.kind() != kind:
                    close()
                    kind = stack.kind()
            elif tag in BLOCKS:
                close()
            continue
        if tag in RAW:
            if not attrs.endswith("/"):
                found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = found.end() if found else n
            text.append(" " if tag != "noscript" else "")
            continue
        if tag in VOID:
            if tag == "hr":
                close()
            else:
                text.append(" " if tag in ("br", "img", "input") else "")
            continue
        if tag in BLOCKS:
            close()
            if stack.blocks:
                top = stack.tags[stack.blocks[-1]]
                if top in _ENDS.get(tag, ()) or (top == "p" and tag in _ENDS_P):
                    stack.cut(stack.blocks[-1])
                    kind = stack.kind()
        now = _kind(tag, attrs, stack.content > 0)
        if kind == _CHROME:
            now = _CHROME
        elif now == _OPEN:
            now = kind
        if now != kind:
            close()
        if attrs.endswith("/") and tag not in BLOCKS:
            continue
        stack.push(tag, now)
        kind = now
    close()
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _parsed(run_tokens: int):
    """Per page: its blocks that may stay, and the names of the suffixes of its other tokens.

    ``suffix`` holds, for each place of the page's stream of tokens outside known content, a hash of
    host and the next tokens, then one of host and all tokens for each of these blocks; the streams
    of pages are apart, so no suffix crosses pages."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in row_batches(batches, 4 << 20, "html"):
            rows = []
            for page_id, url, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
                got = blocks(source or "")
                has_content = any(k == _CONTENT for k, _ in got)
                if has_content:
                    got = [(k if k != _OPEN else _CHROME, t) for k, t in got]
                own = [t.split() for k, t in got if k != _CONTENT]
                rest = [w for b in own for w in b]
                host = host_of(url)
                suffix = [["", host, *rest[i : i + run_tokens]] for i in range(len(rest) - run_tokens + 1)]
                suffix += [["whole", host, *b] for b in own]
                suffix = [xxhash.xxh64_intdigest("\x1f".join(x), 7) - (1 << 63) for x in suffix]
                is_open = any(k == _OPEN for k, _ in got)
                keep = [(k, t if k != _CHROME else len(t.split())) for k, t in got]
                rows.append((page_id, url, xxhash.xxh64_intdigest((source or "").encode("utf-8", "surrogatepass"), 3) - (1 << 63), json.dumps(keep, ensure_ascii=True) if is_open else "\n".join(t for k, t in got if k == _CONTENT), is_open, suffix))
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.string()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.string()), pa.array(c[4]), pa.array(c[5], pa.list_(pa.int64()))], ["page_id", "url", "mark", "kept", "is_open", "suffix"])

    return run


def _unique_runs(kept: str, covered: np.ndarray, run_tokens: int) -> str:
    """The text of a page with open blocks, without the tokens that repeated suffixes and blocks cover."""
    got, out = json.loads(kept), []
    sizes = [t if kind == _CHROME else len(t.split()) for kind, t in got if kind != _CONTENT]
    edge = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    windows = max(0, int(edge[-1]) - run_tokens + 1)
    gone = np.zeros(int(edge[-1]) + 1, np.int64)
    for s in covered:
        a, b = (s, s + run_tokens) if s < windows else edge[s - windows : s - windows + 2]
        gone[a] += 1
        gone[b] -= 1
    gone = np.cumsum(gone) > 0
    block = 0
    for kind, t in got:
        if kind == _CONTENT:
            out.append(t)
            continue
        if kind == _OPEN:
            own = [w for i, w in enumerate(t.split(), int(edge[block])) if not gone[i]]
            if own:
                out.append(" ".join(own))
        block += 1
    return "\n".join(out)


def extracted(pages: DataFrame, run_tokens: int = RUN) -> DataFrame:
    """page_id, url, text, n_chars, boilerplate_runs (suffixes removed from open blocks) of every row of pages with a page_id.

    Null or empty html gives an empty text; a null url is a host of its own; equal pages of one
    page_id do not make each other boilerplate, since runs must lie in distinct pages; a repeated row
    gets its result twice, and rows that share a page_id only are told apart by html; an empty table gives an empty result; other columns are not looked at. A
    page is parsed in time proportional to its length.
    """
    plain = pages.where("page_id is not null").select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    parsed = materialize(plain.mapInArrow(_parsed(run_tokens), "page_id long, url string, mark long, kept string, is_open boolean, suffix array<long>"))  # parsed once
    # the suffix array's groups of equal keys; only those in distinct pages repeat
    repeated = parsed.select("page_id", F.explode("suffix").alias("s")).groupBy("s").agg(F.min("page_id").alias("a"), F.max("page_id").alias("b")).where("a < b").select("s")
    places = parsed.where("is_open").select("page_id", "mark", F.posexplode("suffix").alias("at", "s"))
    covered = places.join(repeated, "s", "left_semi").groupBy("page_id", "mark").agg(F.sort_array(F.collect_set("at")).alias("covered"))
    # pages whose structure settles all blocks stay where they are; only the others meet their runs
    settled = parsed.where("not is_open").select("page_id", "url", F.col("kept").alias("text"), F.char_length("kept").cast("long").alias("n_chars"), F.lit(0).cast("long").alias("boilerplate_runs"))
    joined = parsed.where("is_open").join(covered, ["page_id", "mark"], "left").select("page_id", "url", "kept", "is_open", "covered")

    def finish(batches):
        import pyarrow as pa

        for batch in row_batches(batches, 4 << 20, "kept"):
            rows = []
            for page_id, url, kept, is_open, got in zip(*(batch.column(i).to_pylist() for i in range(5))):
                text = _unique_runs(kept, np.array(got or [], np.int64), run_tokens) if is_open else kept
                rows.append((page_id, url, text, len(text), len(got or [])))
            c = list(zip(*rows))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.string()), pa.array(c[2], pa.string()), pa.array(c[3], pa.int64()), pa.array(c[4], pa.int64())], ["page_id", "url", "text", "n_chars", "boilerplate_runs"])

    return settled.unionByName(joined.mapInArrow(finish, "page_id long, url string, text string, n_chars long, boilerplate_runs long"))
