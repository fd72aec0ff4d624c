"""Main text of web pages by templates deduced from the pages of a host.

* **Tokens.** A page is read into tags, told apart by role, the path of open elements with their
  classes, and text blocks, told apart by role and words. A role is a number of its page with its
  parent's number, and a hash of the path elsewhere, so the work is linear in the page however deep it is.
* **Equivalence classes.** Each token has an occurrence vector over the pages of its host: how
  often it occurs in each. Pages of one body (all text that may be main) count once. Vectors are
  compared by a fingerprint, a sum over pages that partial aggregates build up, so no task sees
  the pages of a host together. Tokens of one vector are a class; it is large and frequent enough if
  it has two tokens, or occurs once in each page, and is in half of the host's pages. A text block
  must also be beside half of the host's different longest blocks, so that copies and near copies of an
  article, whatever their share of the pages, are no template.
* **Template.** A class is valid if it nests: each of its tokens lies, by its path, within
  tokens of valid classes. Valid classes, from the root down, are the host's template.
* **Slots.** What the template leaves open is extracted: text blocks whose own token is not in
  the template, by the path of template elements around them. The main slot is an article or main
  element of the template if that holds half of the host's slot text, and otherwise the deepest element
  that holds most of it, with the article or main element around it. In a slot without one, those
  of the page are preferred if they hold half of its text. Menus, headers, footers, sidebars, notices,
  adverts, forms and comments, known by their elements or classes, are no part of a slot. Within an
  article or main element only a class all of whose words name such parts counts (``comments``, ``ad-box``,
  not ``share-price-table``). Blocks that are mostly links do not count in the choice of the slot,
  and are kept within it.

A host with few different pages has no template; its pages, and those without text in the main
slot, are read by their own elements: article or main, or else where their own text is.

Hosts' templates are joined to the pages; a template is bounded by what half of the pages share.
Defined cases: a null html is empty, a page without text gives an empty text; null and odd urls
are one host; elements may be left open and nested to any depth, and a sign that opens no tag is text;
repeated rows are extracted each. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.reputation import parts_of
from affinity.llm.stage import written

#: Pages that a host needs for a template, and the share of them that a class must be in.
LEAST_PAGES, SHARE = 4, 0.5
#: Shares of the host's slot text that the main slot holds at least, without a name and with one.
MAIN_SHARE, NAMED_SHARE = 0.7, 0.5

#: Fixed names of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q "
                    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr img").split())
RAW = "script style noscript template textarea svg math iframe object select title".split()
ASIDE = frozenset(("nav footer aside form button menu dialog fieldset head figcaption").split())
MAIN = frozenset(("article", "main"))
CLOSED_BY_NEXT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                  "tbody": {"tr", "td", "th", "tbody", "thead"}, "tfoot": {"tr", "td", "th", "tbody", "thead"},
                  "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that a closing tag of an outer one doesn't end by mistake.
FENCES = ("article", "table", "body")
#: Fixed words that name what is not main text, and what is, in classes, ids and roles.
NOT_MAIN = re.compile(
    r"(?:^|[-_ ])(?:nav\w*|menu\w*|header|masthead|footer|side-?bar|aside|notices?|cookies?|consent|banner|ads?|"
    r"advert\w*|sponsor\w*|promo\w*|related|recommend\w*|share|sharing|social|comments?|respond|reply|replies|"
    r"disqus|breadcrumbs?|newsletter|subscri\w+|login|signup|popup|modal|widget|toolbar|pagination|pager|"
    r"contentinfo|complementary|search|alert)(?:$|[-_ ])", re.I)
#: Fixed words that add nothing to the name of a part.
PLAIN_WORDS = frozenset("area bar bars block body box column container content form inner item items link links "
                        "list outer panel section wrap wrapper".split())
IS_MAIN = re.compile(r"(?:^|[-_ ])(?:article-?body|articlebody|main-?content|post-?content|entry-?content|story-?body|"
                     r"main)(?:$|[-_ ])", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>|([^<]+|<)", re.S | re.I)
_NAMES = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z0-9]+")


def names_other_part(called: str) -> bool:
    """Whether all words of one of the names say that this is no main text."""
    for name in called.lower().split():
        words = [w for w in _WORDS.findall(name) if w not in PLAIN_WORDS]
        if words and all(NOT_MAIN.search(w) for w in words):
            return True
    return False


@dataclass
class Element:
    """An open element: its role, and whether its content can be main text."""

    name: str
    role: int
    out: bool
    main: bool


@dataclass
class Page:
    """A page's roles and its text blocks; roles are numbers, the page's own being 0."""

    #: Parent, own name with classes, hash of the path, depth, and number of elements of each role.
    parents: list[int] = field(default_factory=lambda: [0])
    shown: list[str] = field(default_factory=lambda: [""])
    hashes: list[int] = field(default_factory=lambda: [ROOT])
    depths: list[int] = field(default_factory=lambda: [0])
    times: list[int] = field(default_factory=lambda: [1])
    #: Role, text, characters within links, excluded, within an article or main element.
    blocks: list[tuple[int, str, int, bool, bool]] = field(default_factory=list)
    known: dict[tuple[int, str], int] = field(default_factory=dict)

    def role(self, parent: int, shown: str) -> int:
        found = self.known.get((parent, shown))
        if found is None:
            found = self.known[parent, shown] = len(self.parents)
            self.parents.append(parent)
            self.shown.append(shown)
            self.hashes.append(_hash(self.hashes[parent], shown))
            self.depths.append(self.depths[parent] + 1)
            self.times.append(0)
        self.times[found] += 1
        return found


class _Open:
    """The open elements, with the places of each name and of those that are not inline."""

    def __init__(self) -> None:
        self.stack = [Element("", 0, False, False)]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.outer = [0]

    def push(self, element: Element) -> None:
        self.places[element.name].append(len(self.stack))
        if element.name not in INLINE:
            self.outer.append(len(self.stack))
        self.stack.append(element)

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            gone = self.stack.pop()
            self.places[gone.name].pop()
            if self.outer[-1] == len(self.stack):
                self.outer.pop()

    def block(self) -> Element:
        """The innermost element that is not inline."""
        return self.stack[self.outer[-1]]

    def close(self, name: str) -> None:
        """Close the innermost element of the name, unless a fence is open within it."""
        at = self.places[name][-1] if self.places[name] else 0
        if at and not any(self.places[f] and self.places[f][-1] > at for f in FENCES):
            self.cut(at)

    def make_room(self, name: str) -> None:
        """Close what a block element that begins ends: an open paragraph, or its like in a list or table."""
        ended = CLOSED_BY_NEXT.get(name, ())
        while (name_of := self.block().name) == "p" or name_of in ended:
            self.cut(self.outer[-1])


def _tokens(text: str) -> Iterator[tuple[str | None, ...]]:
    """Groups of ``_TOKEN`` in order; behind the last ``>`` no tag begins, and nothing is looked for."""
    at, last = 0, text.rfind(">")
    while at < len(text):
        if at > last and not text.startswith("<!--", at):
            end = text.find("<!--", at)
            end = len(text) if end < 0 else end
            yield None, None, None, None, text[at:end]
            at = end
        else:
            found = _TOKEN.match(text, at)
            yield found.groups()
            at = found.end()


def parse(text: str) -> Page:
    """Read a page; elements left open and tags closed out of turn are forgiven."""
    page, opened = Page(), _Open()
    words: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if words:
            block = _SPACE.sub(" ", entities.unescape("".join(words))).strip()
            if block:
                inner = opened.stack[-1]
                page.blocks.append((opened.block().role, block, linked, inner.out, inner.main))
            words.clear()
        linked = 0

    for raw, closing, name, rest, plain in _tokens(text):
        if plain is not None:
            words.append(plain)
            if opened.places["a"]:
                linked += len(plain)
            continue
        if raw is not None:
            if raw.lower() not in ("svg", "math"):
                words.append(" ")
            continue
        if name is None:
            continue
        name = name.lower()
        inline = name in INLINE
        if not inline:
            flush()
        if closing:
            opened.close(name)
            continue
        if not inline:
            opened.make_room(name)
        top = opened.stack[-1]
        called = " ".join(v for _, a, b, c in _NAMES.findall(rest) for v in (a or b or c,)) if "=" in rest else ""
        role = opened.block().role
        if not inline:
            shown = f"{name}.{re.sub(r'[0-9]{3,}', '', called)[:60]}" if called else name
            role = page.role(role, shown)
        if name not in VOID and not rest.endswith("/"):
            main = name in MAIN or bool(called and IS_MAIN.search(called))
            if top.main:
                other = bool(called) and names_other_part(called)
            else:
                other = bool(called and (not main or name == "article") and NOT_MAIN.search(called))
            out = top.out or name in ASIDE or (name == "header" and not top.main) or other
            opened.push(Element(name, role, out, top.main or main))
    flush()
    return page


def _hash(within: int, own: str) -> int:
    """A 63-bit hash of a token in a role, or of a role in its parent; the same on all machines."""
    made = hashlib.blake2b(f"{within}\0{own}".encode("utf-8", "replace"), digest_size=8)
    return int.from_bytes(made.digest(), "little") >> 1


ROOT = _hash(0, "")


def slot_text(page: Page) -> list[int]:
    """Characters of text that may be main within each role; the root's are those of the page."""
    chars = [0] * len(page.parents)
    for role, block, linked, out, _ in page.blocks:
        if not out and linked <= len(block) / 2:
            chars[role] += len(block)
    for role in range(len(chars) - 1, 0, -1):  # parents come before their children
        chars[page.parents[role]] += chars[role]
    return chars


def host_tokens(pages: DataFrame) -> DataFrame:
    """``host, token, body, longest, role, times, chars``, once for each body within a batch.

    Tags, and the root, have a role (``parent, shown, depth``; the token is its hash) and the characters
    of slot text within them; text blocks have a null role. ``body`` and ``longest`` are hashes of
    the text that may be main and of its longest block.
    """
    role_type = pa.struct([("parent", pa.int64()), ("shown", pa.string()), ("depth", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most: dict[tuple, list[int]] = {}
            for host, text in zip(*(batch.column(c).to_pylist() for c in ("host", "html")), strict=True):
                page = parse(text or "")
                chars = slot_text(page)
                own = [block for _, block, _, out, _ in page.blocks if not out]
                body = _hash(0, "\0".join(own))
                longest = _hash(0, max(own, key=lambda block: (len(block), block), default=""))
                seen = [(page.hashes[r], (page.hashes[page.parents[r]], page.shown[r], page.depths[r]),
                         page.times[r], chars[r]) for r in range(len(chars))]
                seen += [(_hash(page.hashes[r], block), None, n, 0)
                         for (r, block), n in Counter((b[0], b[1]) for b in page.blocks).items()]
                for token, role, n, held in seen:
                    row = most.setdefault((host, token, body, longest, role), [0, 0])
                    row[0] = max(row[0], n)
                    row[1] = max(row[1], held)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            roles = [None if k[4] is None else dict(zip(("parent", "shown", "depth"), k[4], strict=True)) for k in most]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k[i] for k in most], kind) for i, kind in enumerate(types)], pa.array(roles, role_type),
                 *[pa.array([v[i] for v in most.values()], pa.int64()) for i in range(2)]],
                ["host", "token", "body", "longest", "role", "times", "chars"])

    return pages.select("host", "html").mapInArrow(
        run, "host string, token long, body long, longest long, "
             "role struct<parent: long, shown: string, depth: int>, times long, chars long")


def host_templates(pages: DataFrame) -> DataFrame:
    """``host, template, slots``: the tokens of valid classes; slot roles with their text.

    ``template`` has the hashes of the tokens, text blocks, of all classes that are large and frequent
    enough; ``slots`` has the roles of the tags among them with the characters of slot text within.
    Nesting is checked where the template is used.
    """
    once_a_body = host_tokens(pages).groupBy("host", "token", "role", "body", "longest").agg(
        *[F.max(c).alias(c) for c in ("times", "chars")])
    mark = F.xxhash64("body", "times")
    halves = mark.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(mark, 32)  # sums do not overflow
    sums = ("pages", "times", "vector", "vector_high", "chars")
    tokens = (once_a_body.groupBy("host", "token", "role", "longest").agg(
        F.count("*").alias("pages"), F.sum("times").alias("times"),
        F.sum(halves[0]).alias("vector"), F.sum(halves[1]).alias("vector_high"), F.sum("chars").alias("chars"))
        .groupBy("host", "token", "role").agg(F.count("*").alias("beside"), *[F.sum(c).alias(c) for c in sums]))
    tokens = written(tokens.where((F.col("pages") >= SHARE * LEAST_PAGES) | (F.col("token") == ROOT)))
    counts = tokens.where((F.col("token") == ROOT) & (F.col("pages") >= LEAST_PAGES)).select(
        "host", F.col("pages").alias("host_pages"), F.col("beside").alias("host_longest"))
    frequent = written(tokens.join(written(counts), "host").where(F.col("pages") >= SHARE * F.col("host_pages")))
    sizes = frequent.groupBy("host", "vector", "vector_high").agg(F.count("*").alias("size"))
    once = (F.col("times") == F.col("pages")) & (F.col("pages") == F.col("host_pages"))
    large = (F.col("size") > 1) | once
    various = (F.col("host_longest") >= LEAST_PAGES) & (F.col("beside") >= SHARE * F.col("host_longest"))
    return (frequent.join(sizes, ["host", "vector", "vector_high"])
            .groupBy("host").agg(
                F.collect_list(F.when(F.col("role").isNull() & large & various, F.col("token"))).alias("template"),
                F.collect_list(F.when(F.col("role").isNotNull(), F.struct(
                    F.col("token").alias("role"), "role.parent", "role.shown", "role.depth", "chars",
                    large.alias("large"))))
                .alias("slots")))


def valid_roles(slots: list[dict]) -> dict[int, dict]:
    """Roles of valid classes, from the root down."""
    valid = {ROOT: {"role": ROOT, "parent": ROOT, "shown": "", "depth": 0, "chars": 0}}
    for slot in sorted(slots, key=lambda s: (s["depth"], s["role"])):
        if slot["large"] and slot["parent"] in valid:
            valid[slot["role"]] = slot
    return valid


def is_main(shown: str) -> bool:
    """Whether a role's element is an article or main element, or is called so."""
    name, _, called = shown.partition(".")
    return name in MAIN or bool(IS_MAIN.search(called))


def main_slot(roles: dict[int, dict]) -> int:
    """The role that holds the main text: named so, or the deepest with most of it."""
    whole = roles[ROOT]["chars"]
    named = [r for r in roles.values() if is_main(r["shown"]) and r["chars"] >= NAMED_SHARE * whole > 0]
    if named:
        return min(named, key=lambda r: (r["depth"], -r["chars"], r["role"]))["role"]
    enough = [r for r in roles.values() if r["depth"] and r["chars"] >= MAIN_SHARE * whole > 0]
    slot = max(enough, key=lambda r: (r["depth"], r["role"]), default=roles[ROOT])["role"]
    around, outermost = slot, slot
    while around != ROOT:
        if is_main(roles[around]["shown"]):
            outermost = around
        around = roles[around]["parent"]
    return outermost


def own_roles(page: Page) -> dict[int, dict]:
    """The page's roles as those of a template."""
    return {page.hashes[r]: {"role": page.hashes[r], "parent": page.hashes[page.parents[r]], "shown": page.shown[r],
                             "depth": page.depths[r], "chars": chars} for r, chars in enumerate(slot_text(page))}


def _within(page: Page, blocks: list[tuple], slot: int) -> list[tuple]:
    inside = [False] * len(page.parents)
    for role, parent in enumerate(page.parents):  # parents come before their children
        inside[role] = page.hashes[role] == slot or (role > 0 and inside[parent])
    return [b for b in blocks if inside[b[0]]]


def main_text(page: Page, template: frozenset[int], roles: dict[int, dict] | None) -> str:
    """The blocks of the page's main slots, joined by one space; ``roles`` are the template's valid ones."""
    kept = [b for b in page.blocks if not b[3] and _hash(page.hashes[b[0]], b[1]) not in template]
    named = [b for b in kept if b[4]]
    inside = []
    if roles:
        slot = main_slot(roles)
        inside = _within(page, kept, slot)
        of_slot = [b for b in inside if b[4]]
        if not is_main(roles[slot]["shown"]) and sum(len(b[1]) for b in of_slot) >= NAMED_SHARE * sum(
                len(b[1]) for b in inside if b[2] <= len(b[1]) / 2):
            inside = of_slot or inside
    if not inside and named:
        inside = named
    elif not inside:
        inside = _within(page, kept, main_slot(own_roles(page)))
    return " ".join(b[1] for b in inside)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, tuple] = {}
            texts = []
            hosts, htmls = batch.column("host").to_pylist(), batch.column("html").to_pylist()
            for k, (host, text) in enumerate(zip(hosts, htmls, strict=True)):
                if host not in known:
                    slots = batch.column("slots")[k].as_py()
                    known[host] = (frozenset(batch.column("template")[k].as_py() or ()),
                                   valid_roles(slots) if slots else None)
                texts.append(main_text(parse(text or ""), *known[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    host, _ = parts_of(F.coalesce("url", F.lit("")))
    read = pages.select("page_id", "url", "html", host.alias("host"))
    templates = written(host_templates(read))
    return read.join(templates, "host", "left").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
