"""HTML extraction by equivalence-class template deduction (operator 10).

A page's template tokens are its tags, but for those within a block of text,
told apart by the containers about them, and its whole blocks of text.  Tokens
of one container that have the same occurrence vector over a host's pages are an
equivalence class.  Classes that are frequent, large and ordered are valid; valid
containers, nested, are the host's template.  Text belongs to the slot of the
innermost template container about it.  The main text is what the slots under
the template's main container hold, but for containers in it that say the same
on all pages, and so have no slot, and those marked as something else.
"""

from __future__ import annotations

import html
import re
import struct
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import materialize, sliced, workspace
from .urls import host_of

#: Share of a host's different pages, two at least, that a class must occur in, and tokens that it must have.
SUPPORT, LARGE = 0.005, 2
#: Share of the different pages with a container, and their least number, on which a block is alike to be the template's own.
ALIKE, ALIKE_PAGES = 0.9, 5
#: Share of a slot's text that a container inside must hold to be gone into, and how much a telling name counts.
MOST, NAMED = 0.7, 8
#: Paths and pages that a task remembers at once.
MEMO = 100_000

# Elements by their part in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark object q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
RAW = frozenset("script style noscript template iframe textarea select svg title annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose nesting is followed.  Others, like p and li, are often left open.
CONTAINERS = frozenset("article aside body button details dialog div dl fieldset figure footer form head header html main menu nav ol section table ul".split())
ASIDE = frozenset("aside button dialog footer form head menu nav".split())
MAIN = frozenset("article main".split())
#: Containers that say nothing of what they hold, as a list or a table does.
BOXES = frozenset("div section".split())
#: Words of class, id and role that mark what isn't main text, or is.
ASIDE_WORDS = frozenset("ad ads adsbygoogle advert adverts advertisement advertising banner breadcrumb breadcrumbs comment commentlist comments complementary consent contentinfo cookie cookies disqus footer form gdpr menu modal nav navbar navigation newsletter notice notices outbrain popup promo promoted promotion related reply replies search share sharing sidebar signup social sponsor sponsored subscribe subscription taboola toolbar widget widgets".split())
MAIN_WORDS = frozenset("article articlebody content entry main post story".split())
#: Those that mark a main element too.
ANSWER_WORDS = frozenset("ad ads adsbygoogle advert advertisement comment commentlist comments disqus outbrain promo related replies reply sponsored taboola".split())
#: Words that say of a box where it is or that it is one, and so leave a name's meaning to its other words.
BOX_WORDS = frozenset("area articles bar block bottom box button buttons center cell col column container content desktop div entry float footer global google group head header holder horizontal icons inline inner item items left links list main middle mobile outer page panel post posts primary right row secondary section site slot small stories sticky story text top unit vertical wrap wrapper".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: An element that no browser shows, by an attribute without and with a value.
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
NOT_SHOWN = re.compile(r"(?:^|\s)(?:aria-hidden\s*=\s*[\"']?true|style\s*=\s*(?:\"[^\"]*|'[^']*)display\s*:\s*none)", re.I)
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
TELLING = re.compile("class|id|role|style", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")
#: Words of a name, as in ``promoBox``, ``promo-box`` and ``promo_box2``.
NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Marks of a container's signature.
AS_ASIDE, AS_ANSWER, AS_MAIN = "\x1da", "\x1db", "\x1dm"


@dataclass
class Page:
    """A page cut into template tokens and blocks of text.

    ``tags`` has each tag token's count, first place and container, ``paths``
    every container's path by its token, and ``blocks`` the container and text of
    each block, in page order.
    """

    tags: dict[int, tuple[int, int, int]] = field(default_factory=dict)
    paths: dict[int, tuple[str, ...]] = field(default_factory=dict)
    blocks: list[tuple[int, str]] = field(default_factory=list)


class PathTokens(dict):
    """Tokens of container paths, and of tags within them; forgets all when full."""

    def __missing__(self, key: tuple) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[key] = h = xxhash.xxh64_intdigest("\x1f".join(map(str, key))) - (1 << 63)
        return h


def marks(attributes: str) -> str:
    """What an element's names and attributes say that it is: ``AS_ASIDE``, ``AS_ANSWER`` or ``AS_MAIN``, or nothing.

    A name says so by its words, of which the others must be words for boxes: a
    ``promoBox`` is an advert, but ``related-work`` and a ``dinner-menu`` aren't
    what one of their words means alone.
    """
    if not TELLING.search(attributes):
        return ""
    if NOT_SHOWN.search(attributes) or HIDDEN.search(QUOTED.sub("''", attributes)):
        return AS_ANSWER
    out = ""
    for m in ATTRIBUTE.findall(attributes):
        for name in "".join(m[1:]).split():
            words = {w.lower() for w in NAME_WORDS.findall(name) if len(w) > 1}
            signs = words & ASIDE_WORDS
            if signs and not words - signs - BOX_WORDS:
                out += AS_ANSWER if signs & ANSWER_WORDS else AS_ASIDE
            elif words & MAIN_WORDS:
                out += AS_MAIN
    return AS_ANSWER if AS_ANSWER in out else out and (AS_ASIDE if AS_ASIDE in out else "") + (AS_MAIN if AS_MAIN in out else "")


def signature(name: str, attributes: str) -> str:
    """A container's name with the words of its class, id and role, and its marks."""
    if not attributes:
        return name
    words = sorted({w for m in ATTRIBUTE.findall(attributes) for w in SPLIT.split("".join(m[1:]).lower()) if w and not w.isdigit()})
    return " ".join([name, *words]) + marks(attributes)


NAME = re.compile(r"[^ \x1d]+")
#: Elements that end an open paragraph.
BLOCKS = CONTAINERS | frozenset("blockquote center dd dt h1 h2 h3 h4 h5 h6 hr li p pre tbody td tfoot th thead tr".split())
#: What ends an element that is often left open.
CELLS = frozenset("td th tr".split())
ENDED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": CELLS, "th": CELLS, "tr": {"tr", "tbody", "tfoot"}}
TOKENS = PathTokens()
ROOT = TOKENS[()]


def block_token(container: int, text: str) -> int:
    return xxhash.xxh64_intdigest(text, container & ((1 << 64) - 1)) - (1 << 63)


def parse(source: str) -> Page:
    """Cut a page into tags and blocks; unclosed and cut-off tags do no harm."""
    page, stack, at = Page(paths={ROOT: ()}), [], 0
    counts: dict[int, list[int]] = {}
    parts: list[str] = []
    container = ROOT
    # A marked element that isn't a container: its name, how many such are open, the containers about it, and open blocks in it.
    skipped, depth, outer, inner = "", 0, 0, 0

    def text(end: int) -> None:
        if end > at and not skipped:
            parts.append(source[at:end])

    def close_block() -> None:
        if parts:
            words = " ".join(html.unescape("".join(parts)).split())
            if words:
                page.blocks.append((container, words))
            parts.clear()

    def tag(token: int, owner: int) -> None:
        own = counts.get(token)
        if own is None:
            counts[token] = [1, len(counts), owner]
        else:
            own[0] += 1

    pos = 0
    while m := TOKEN.search(source, pos):
        text(m.start())
        pos = at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if skipped:
            own_place = len(stack) <= outer
            ends = False
            if closing and name == skipped and own_place:
                depth -= 1
                ends = not depth
            elif closing and name in CONTAINERS:
                ends = own_place and any(NAME.match(part)[0] == name for part in stack)
            elif closing and name in BLOCKS:
                inner -= 1
                ends = inner < 0 and own_place
            elif not closing and own_place and name in ENDED_BY.get(skipped, ()):
                ends = True
            elif not closing and name == skipped and own_place:
                depth += 1
            elif not closing and name in BLOCKS and name not in CONTAINERS:
                inner += 1
            if ends:
                same, skipped = name == skipped, ""
                if same and closing and name in INLINE:
                    continue
        if name not in INLINE:
            close_block()
        if name in RAW and not closing and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, pos)
            pos = at = end.end() if end else len(source)
        if name not in CONTAINERS:
            if attributes and not closing and not skipped and name not in VOID and name not in RAW and not attributes.endswith("/"):
                mark = marks(attributes)
                if AS_ANSWER in mark or mark == AS_ASIDE and name not in INLINE:
                    skipped, depth, outer, inner = name, 1, len(stack), 0
            # What marks up a text within a block is part of the text, not of the template.
            if name not in INLINE and name not in VOID:
                tag(TOKENS[container, closing, name], container)
        elif not closing:
            stack.append(signature(name, attributes))
            path = tuple(stack)
            container = TOKENS[path]
            page.paths.setdefault(container, path)
            tag(container, container)
        else:
            for i in range(len(stack) - 1, -1, -1):
                if NAME.match(stack[i])[0] == name:
                    owner = TOKENS[tuple(stack[: i + 1])]
                    tag(TOKENS[owner, closing, name], owner)
                    del stack[i:]
                    container = TOKENS[tuple(stack)]
                    break
    text(len(source))
    close_block()
    page.tags = {token: tuple(own) for token, own in counts.items()}
    return page


def main_name(part: str) -> bool:
    """Whether a container is named as main text."""
    return NAME.match(part)[0] in MAIN or AS_MAIN in part


def is_aside(path: Sequence[str]) -> bool:
    """Whether a container on the path holds something other than main text."""
    inside = False
    for part in path:
        name = NAME.match(part)[0]
        if name in ("html", "body"):
            continue
        if name in ASIDE or AS_ANSWER in part or AS_ASIDE in part and not main_name(part):
            return True
        if not inside and (name == "header" or "header" in part.partition("\x1d")[0].split(" ")):
            return True
        inside = inside or name in MAIN
    return False


def text_key(page: Page) -> int:
    """The same for pages that have the same text outside of what is named as something else: copies count once."""
    texts = sorted({(c, t) for c, t in page.blocks if not is_aside(page.paths[c])})
    return xxhash.xxh64_intdigest("\x1e".join(f"{c} {t}" for c, t in texts)) - (1 << 63)


@dataclass
class Template:
    """A host's template.

    ``slots`` has, for each frequent container, whether it is in a valid class,
    the different pages that have it and the characters of text right in it that
    isn't the template's own.
    """

    slots: dict[int, tuple[bool, int, int]] = field(default_factory=dict)

    def packed(self) -> bytes:
        rows = [x for c, (valid, pages, chars) in self.slots.items() for x in (c, int(valid), pages, chars)]
        return struct.pack(f"<{len(rows)}q", *rows)

    @classmethod
    def unpacked(cls, data: bytes) -> Template:
        x = np.frombuffer(data, "<i8").tolist()
        return cls({x[i]: (bool(x[i + 1]), x[i + 2], x[i + 3]) for i in range(0, len(x), 4)})


def deduce(pages: Sequence[Page]) -> Template:
    """The template of some pages of one host, in one place; ``deduce_hosts`` does the same over a table."""
    different = list({text_key(p): p for p in pages}.values())
    vectors = {t: tuple(p.tags[t][0] if t in p.tags else 0 for p in different) for p in different for t in p.tags}
    owners = {t: own[2] for p in different for t, own in p.tags.items()}
    sizes = Counter(vectors.values())
    classes: dict[tuple, list[int]] = defaultdict(list)
    for token, vector in vectors.items():
        classes[owners[token], vector].append(token)
    least = max(2, SUPPORT * len(different)) if len(different) > 1 else 1
    valid = set()
    for (_, vector), tokens in classes.items():
        orders = {tuple(sorted(tokens, key=lambda t: p.tags[t][1])) for p, n in zip(different, vector, strict=True) if n}
        if sizes[vector] >= LARGE and len(orders) == 1:
            valid.update(tokens)
    support = {t: sum(map(bool, v)) for t, v in vectors.items()}
    containers = {c for p in different for c in p.paths if c != ROOT}
    blocks: Counter = Counter()
    chars: Counter = Counter()
    owner_of = {}
    for p in different:
        for c, text in p.blocks:
            owner_of[block_token(c, text)] = c
            chars[block_token(c, text)] += len(text)
        blocks.update({block_token(c, text) for c, text in p.blocks})
    pages_with = lambda c: len(different) if c == ROOT else support[c]
    alike = frozenset(b for b, n in blocks.items() if n >= max(ALIKE_PAGES, ALIKE * pages_with(owner_of[b])))
    own: Counter = Counter()
    for b, n in chars.items():
        if b not in alike:
            own[owner_of[b]] += n
    slots = {c: (c in valid, support[c], own[c]) for c in containers if support[c] >= least}
    return Template({ROOT: (True, len(different), own[ROOT])} | slots)


def main_container(page: Page, slot_of: dict[int, int], weight: Counter) -> tuple[str, ...]:
    """The path of the template container whose slots hold the main text.

    From the root on, the container is gone into that holds most of the text of
    the slot, over the host's pages; one that is named as main text counts
    ``NAMED`` times, and is gone into no further but for an article in it, and
    one that is named as something else doesn't count.
    """
    slots = {page.paths[s]: s for s in set(slot_of.values()) if not is_aside(page.paths[s])}
    total: Counter = Counter()
    for path, s in slots.items():
        for i in range(len(path) + 1):
            total[path[:i]] += weight[s]
    at: tuple[str, ...] = ()
    while True:
        inside = {path[:n] for path in slots if len(path) > len(at) and path[: len(at)] == at for n in range(len(at) + 1, len(path) + 1)}
        inside = [p for p in inside if total[p] and not any(len(q) < len(p) and p[: len(q)] == q for q in inside)]
        if not inside:
            return at
        named = {p: main_name(p[-1]) for p in inside}
        if at and main_name(at[-1]):
            # What is named as the text is whole: only a part that is the article itself is gone into.
            inside = [p for p in inside if NAME.match(p[-1])[0] == "article" and NAME.match(at[-1])[0] != "article"]
            if not inside:
                return at
        best = max(inside, key=lambda p: (total[p] * (NAMED if named[p] else 1), p))
        if not named[best] and total[best] < MOST * total[at]:
            return at
        at = best


def main_text(page: Page, template: Template) -> str:
    """What the slots of the main text hold, block by block.

    A container that the template doesn't know, as on a page unlike the host's
    others, is a slot if it is one by the page alone.
    """
    alone: Template | None = None
    slot_of: dict[int, int] = {}
    for container, path in page.paths.items():
        slot = ROOT
        for i in range(1, len(path) + 1):
            part = TOKENS[path[:i]]
            known = template.slots.get(part)
            if known is None:
                alone = alone or deduce([page])
                known = alone.slots.get(part)
            if known is None or not known[0]:
                break
            slot = part
        slot_of[container] = slot
    here = Counter()
    for c, text in page.blocks:
        here[c] += len(text)
    # The page is one more example of its host's pages, and the only one of what they don't have.
    weight: Counter = Counter()
    for c, slot in slot_of.items():
        _, pages, chars = template.slots.get(c, (False, 0, 0))
        weight[slot] += (chars + here[c]) / (pages + 1)
    main = main_container(page, slot_of, weight)
    fixed = without_slots(page, template, len(main))
    chosen = {c for c, s in slot_of.items() if page.paths[s][: len(main)] == main and c not in fixed and not is_aside(page.paths[s])}
    return " ".join(text for c, text in page.blocks if c in chosen)


def without_slots(page: Page, template: Template, depth: int) -> set[int]:
    """Boxes deeper than ``depth`` in which no page's text varies, nor in any container within, and all in them: the template's own."""
    varies: set[tuple[str, ...]] = set()
    for c, path in page.paths.items():
        _, pages, chars = template.slots.get(c, (False, 0, 1))
        if chars or pages < ALIKE_PAGES:
            varies.update(path[:i] for i in range(len(path) + 1))
    boxes = {path for path in page.paths.values() if len(path) > depth and path not in varies and NAME.match(path[-1])[0] in BOXES}
    return {c for c, path in page.paths.items() if any(path[:i] in boxes for i in range(depth + 1, len(path) + 1))}


def extract(sources: Sequence[str]) -> list[str]:
    """The main text of each of some pages of one host."""
    pages = [parse(s) for s in sources]
    template = deduce(pages)
    return [main_text(p, template) for p in pages]


TAG_ROWS = "host string, page long, token long, owner long, n long, place long, chars long"


def page_tokens(rows: DataFrame) -> DataFrame:
    """Tokens of each different page of ``host`` and ``html``; ``place`` is null for blocks, and a row of null token is the page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in (part for whole in batches for part in sliced(whole, 1)):
            out: list[tuple] = []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = parse(source)
                key = text_key(page)
                if (host, key) in seen:
                    continue
                if len(seen) >= MEMO:
                    seen.clear()
                seen.add((host, key))
                out.append((host, key, None, None, 1, None, 0))
                out += [(host, key, token, owner, n, place, 0) for token, (n, place, owner) in page.tags.items()]
                chars: dict[tuple[int, int], int] = {}
                for c, text in page.blocks:
                    token = block_token(c, text)
                    chars[token, c] = chars.get((token, c), 0) + len(text)
                out += [(host, key, token, c, 1, None, n) for (token, c), n in chars.items()]
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if i else pa.string()) for i, c in enumerate(columns)],
                names=["host", "page", "token", "owner", "n", "place", "chars"],
            )

    return rows.select("host", "html").mapInArrow(run, TAG_ROWS)


def deduce_hosts(rows: DataFrame, path: str) -> DataFrame:
    """``host`` and packed ``template`` of every host of ``host``, ``html``, over all of its pages.

    Occurrence vectors are never in one place: a vector is known by three sums
    of counts times hashes of the pages, which add up before the shuffle, so
    that a host may have any number of pages.  A host's template has no more
    containers than the mean page divided by ``SUPPORT``.
    """
    found = materialize(page_tokens(rows), f"{path}/tokens")
    # Copies in different tasks: one row for each different page and token.
    once = found.groupBy("host", "page", "token", "owner").agg(
        F.max("n").alias("n"),
        F.max("place").alias("place"),
        F.max("chars").alias("chars"),
    )
    once = materialize(once, f"{path}/different")
    h = F.xxhash64("page", F.lit("vector"))
    lanes = [F.sum(F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << 21) - 1)) * F.col("n")).alias(f"v{at}") for at in (0, 21, 42)]
    sums = once.groupBy("host", "token", "owner", F.col("place").isNotNull().alias("tag")).agg(
        *lanes,
        F.count(F.lit(1)).alias("pages"),
        F.sum("chars").alias("chars"),
    )
    sums = materialize(sums, f"{path}/vectors")
    hosts = sums.where("token IS NULL").select("host", F.col("pages").alias("different"))
    least = F.when(F.col("different") > 1, F.greatest(F.lit(2.0), SUPPORT * F.col("different"))).otherwise(1.0)
    tags = sums.where("tag").join(hosts, "host").where(F.col("pages") >= least)
    tags = tags.select("host", "token", "owner", "pages", F.xxhash64("v0", "v21", "v42", "pages").alias("vector"))
    tags = tags.withColumn("class", F.xxhash64("owner", "vector"))
    tags = materialize(tags, f"{path}/tags")
    large = tags.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= LARGE)
    # The order of a class's tokens in each page and container, and whether it is one.
    placed = once.where("place IS NOT NULL").select("host", "page", "token", "place").join(
        tags.select("host", "token", "class"),
        ["host", "token"],
    )
    order = placed.groupBy("host", "page", "class").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("order"))
    order = order.select("host", "class", F.xxhash64(F.transform("order", lambda t: t["token"])).alias("order"))
    orders = order.groupBy("host", "class").agg((F.min("order") == F.max("order")).alias("ordered"))
    containers = tags.where("token = owner").join(orders, ["host", "class"]).join(large, ["host", "vector"], "left")
    containers = containers.select("host", "owner", (F.col("ordered") & F.col("size").isNotNull()).alias("valid"), "pages")
    root = hosts.select("host", F.lit(ROOT).alias("owner"), F.lit(True).alias("valid"), F.col("different").alias("pages"))
    containers = materialize(containers.unionByName(root), f"{path}/containers")
    blocks = sums.where("NOT tag AND token IS NOT NULL").select("host", "token", "owner", F.col("pages").alias("n"), "chars")
    # Most blocks are on too few pages to be the template's, whatever their container: they are summed without a join.
    few = blocks.where(F.col("n") < ALIKE_PAGES).groupBy("host", "owner").agg(F.sum("chars").alias("chars"))
    many = blocks.where(F.col("n") >= ALIKE_PAGES).join(containers, ["host", "owner"])
    many = materialize(
        many.select("host", "token", "owner", "chars", (F.col("n") >= ALIKE * F.col("pages")).alias("alike")),
        f"{path}/repeated",
    )
    chars = few.unionByName(many.where("NOT alike").select("host", "owner", "chars")).groupBy("host", "owner").agg(F.sum("chars").alias("chars"))
    slots = containers.join(chars, ["host", "owner"], "left").groupBy("host").agg(F.collect_list(F.struct("owner", "valid", "pages", F.coalesce("chars", F.lit(0)).alias("chars"))).alias("slots"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [Template({s["owner"]: (s["valid"], s["pages"], s["chars"]) for s in slots}).packed() for slots in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["host", "template"])

    return materialize(slots.mapInArrow(pack, "host string, template binary"), f"{path}/templates")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` of every page.

    A host's template is deduced over all of its pages; pages whose url has no
    host are one host.  Pages of the same text count once in the deduction, and
    each is extracted.  A page that shares nothing with others is its own
    template.  A null html is empty and its text too; html is read whole,
    however long.  Repeated rows are extracted each; a null id is kept; extra
    columns are ignored.  Within the main container nothing goes for being
    repeated but whole containers, like a letter's sign-up box, that are alike on
    ``ALIKE`` of the different pages with them, ``ALIKE_PAGES`` at least; a
    heading or sentence beside text that varies stays.  Elements of any kind that
    are hidden, or named as an advert or as readers' comments, go.
    """
    host = F.coalesce(host_of(F.col(url_col))[0], F.lit(""))
    rows = pages.select(
        host.alias("host"),
        F.coalesce(html_col, F.lit("")).alias("html"),
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
    )
    templates = deduce_hosts(rows, workspace(pages.sparkSession, "html"))
    schema = T.StructType([T.StructField(id_col, pages.schema[id_col].dataType), T.StructField(url_col, T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template] = {}
        for batch in (part for whole in batches for part in sliced(whole, 1)):
            texts = []
            for i, (host, source) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if host not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[host] = Template.unpacked(batch.column(4)[i].as_py())
                texts.append(main_text(parse(source), known[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(3), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=schema.names,
            )

    return rows.join(templates, "host").select("host", "html", "id", "url", "template").mapInArrow(run, schema)
