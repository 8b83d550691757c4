"""Main text of web pages by template deduction.

Pages of one host come from a few templates. Tokens of a page are its elements, named by their paths (tags with their classes
and ids from the root on), and the text of each block, which is all that the block's occurrences hold and stands in each.
The steps, each over all pages of a host:

1. A token's occurrence vector says on which pages of the host it is, and how often. Tokens with the same vector form a
   class: `html`, `nav`, `article` and `footer`, once on every page, are one; `li` and the `a` in it another.
2. A class is ordered if its tokens come in one order, start tags and end tags, and come so again and again, on every page.
3. Ordered classes nest: each occurrence of a class lies between the same two tokens of another, or none, on every page.
4. A class that is not ordered or does not nest came about by chance; it breaks up into its blocks, each with the text of its
   own that it holds. The others, nested, are the template; a text in one of them is template, too. Other blocks' texts are
   in its slots.

A page's text is that of its slots. Those that hold menus, adverts, notices, forms, comments and so on say so by tag,
class or id and are left out. Where the host's template or the page names an element as its article, the slots in it are
the text; where nothing is named, all slots are.

Vectors are not kept: sums of a hash of each page and count stand for one. So every task folds its pages to a row per host
and token, and the steps after the first to a row per host and class. Pages are parsed once for all steps, to the numbers of
their tokens in order, and once for the text.
"""

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.frames import stored

# Pages that make a template: what fewer have in common may be chance.
MIN_PAGES = 3
# Rows a task folds before it hands them on.
FOLDED = 200_000
# Hosts whose classes a task keeps at hand.
HOSTS = 1_000

# What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section
    summary table tbody td tfoot th thead title tr ul""".split()
)
# An open one of the left ends where one of the right begins.
ENDS = {
    "p": BLOCK - {"body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
    "head": {"body"},
}
RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea".split())
NOT_TEXT = RAW | frozenset("head nav footer aside form menu button select dialog audio video map title".split())
# Words of a class or id that say what an element is for.
NOT_ARTICLE = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr
    notice notices alert popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb
    breadcrumbs footer comment comments disqus reply replies respond related share sharing social toolbar widget widgets
    login signup search pagination pager skip masthead""".split()
)
# Words that may stand beside one of those above in the name of furniture: related-posts, share-buttons, ad-box. With any
# other word a name is about something: related-work, share-prices.
COMPANIONS = frozenset(
    """area article articles bar block body bottom box button buttons center col column container content count entry
    fixed float footer form group head header holder icon icons inner input item items js l large left link links list
    m main message mobile module navbar new outer page panel post posts primary r right row s secondary section side site
    slot small sticky story stories text thread title toggle top unit user users web wrap wrapper""".split()
)
# Only these are furniture by a class or id; headings, paragraphs, items and inline elements are not.
CONTAINER = frozenset("div section ul ol dl table tbody tr td details fieldset center figure".split())
# Words before one of those above that say it is beside or missing: has-sidebar, with-comments, no-ads.
BESIDE = frozenset("has have with without no not hide show is in before after above below".split())
# An element named as furniture that holds this share of a page's text is the page's wrapper, not a part of it.
WRAPPER_SHARE = 0.9
# What furniture is called in a label.
_PART = "-"
ARTICLE = frozenset("article content main post entry story text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>|<[!?/][^>]*>", re.DOTALL
)
# Their text runs to their own end tag, whatever it looks like.
_RAW_END = {
    tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE)
    for tag in "script style noscript noembed noframes iframe textarea title xmp template".split()
}
_NAMES = re.compile(r"""(?:^|\s)(class|id)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")
_NUMBER = re.compile(r"\b\d+\b")
_HOST = re.compile(r"^.*?://([^/?#]*)", re.DOTALL)


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def elements(source: str) -> Iterator[tuple[str, str, str]]:
    """The page as events: ("open", tag, label), ("close", tag, ""), ("text", "", text). The label is the tag with its
    class and id. End tags that HTML leaves out are supplied; those of nothing open are skipped."""
    stack: list[str] = []
    at, next_at = 0, 0
    while found := _TOKEN.search(source, next_at):
        tag = (found[2] or "").lower()
        if found.start() > at:
            yield "text", "", source[at : found.start()]
        at = next_at = found.end()
        if not tag:
            continue
        if found[1]:
            if tag in stack:
                while True:
                    last = stack.pop()
                    yield "close", last, ""
                    if last == tag:
                        break
            continue
        if tag in BLOCK:
            for ended in _implied(stack, tag):
                yield "close", ended, ""
        yield "open", tag, _label(tag, found[3])
        if tag in VOID or found[3].endswith("/"):
            yield "close", tag, ""
            continue
        stack.append(tag)
        if tag in _RAW_END:
            end = _RAW_END[tag].search(source, at)
            at = next_at = end.start() if end else len(source)
    if at < len(source):
        yield "text", "", source[at:]
    while stack:
        yield "close", stack.pop(), ""


def _implied(stack: list[str], tag: str) -> list[str]:
    """Takes off the stack what `tag` ends: the nearest such element, within its own list, table or section, and all that
    is open in it."""
    for i in range(len(stack) - 1, -1, -1):
        if tag in ENDS.get(stack[i], ()):
            ended = stack[i:][::-1]
            del stack[i:]
            return ended
        if stack[i] in ("ul", "ol", "dl", "table", "article", "section", "div", "main", "body"):
            break
    return []


def _label(tag: str, attributes: str) -> str:
    if "=" not in attributes:
        return tag
    names = " ".join(value.strip("\"'").lower() for _, value in _NAMES.findall(attributes))
    words = sorted(set(_WORD.findall(names)))
    if tag in CONTAINER and not NOT_ARTICLE.isdisjoint(words) and any(map(_is_part, names.split())):
        words.insert(0, _PART)
    # Numbers differ from page to page.
    return ".".join([tag, *(w for w in words if not w.isdigit())])


def _is_part(name: str) -> bool:
    """Whether a class or id names furniture: it has such a word, none before it that says otherwise, and no word that is about
    anything else."""
    words = [word for word in _WORD.findall(name) if not word.isdigit()]
    found = [i for i, word in enumerate(words) if word in NOT_ARTICLE]
    if not found or any(word in BESIDE for word in words[: found[0]]):
        return False
    return all(word in NOT_ARTICLE or word in COMPANIONS for word in words)


def page_events(source: str) -> list[tuple[str, str, str]]:
    """The page's events. A container named as furniture is none where it is a wrapper: it holds every `article` and `main`
    of the page, and where there are neither, nearly all text."""
    events = list(elements(source))
    named = [i for i, (kind, _, value) in enumerate(events) if kind == "open" and f".{_PART}" in value]
    if not named:
        return events
    articles, texts = [0], [0]  # before each event
    for kind, tag, value in events:
        articles.append(articles[-1] + (kind == "open" and tag in ("article", "main")))
        texts.append(texts[-1] + (len(value) if kind == "text" and not value.isspace() else 0))
    ends, open_at = {}, []
    for i, (kind, _, _) in enumerate(events):
        if kind == "open":
            open_at.append(i)
        elif kind == "close":
            ends[open_at.pop()] = i
    for i in named:
        inside, chars = articles[ends[i]] - articles[i], texts[ends[i]] - texts[i]
        wraps = inside == articles[-1] if articles[-1] else chars >= WRAPPER_SHARE * max(texts[-1], 1)
        # One article among related ones is not the page's: what wraps all of them holds most text, too.
        if wraps and 2 * chars >= texts[-1]:
            kind, tag, value = events[i]
            events[i] = (kind, tag, value.replace(f".{_PART}", "", 1))
    return events


def role(label: str) -> int:
    """-1: holds no article text; 2: says that it is the article; 1: may be; 0: neither."""
    tag, *words = label.split(".")
    if tag in NOT_TEXT or tag == "header" or _PART in words:
        return -1
    if tag in ("article", "main"):
        return 2
    if tag in ("div", "section", "td") and not ARTICLE.isdisjoint(words):
        return 2
    return 1 if tag in ("div", "section", "td", "body", "center", "blockquote") else 0


def outline(events: list[tuple[str, str, str]], order: list[str | None] | None = None) -> dict[str, list]:
    """Path to [times, characters of article text below it, what its own block of text is]. The empty path stands for the
    page. Numbers in a text do not count, as they differ from page to page. `order` takes the paths as they open, None for
    each end."""
    order = [] if order is None else order
    order.append("")
    same: dict[str, str] = {}
    found: dict[str, list] = {"": [1, 0, None]}
    paths, blocks, closed = [""], [""], 0
    texts: dict[str, list[str]] = {}
    for kind, tag, value in events:
        if kind == "open":
            path = f"{paths[-1]}/{value}"
            path = same.setdefault(path, path)
            paths.append(path)
            order.append(path)
            blocks.append(path if tag in BLOCK else blocks[-1])
            found.setdefault(path, [0, 0, None])[0] += 1
            closed += role(value) < 0
        elif kind == "close":
            blocks.pop()
            order.append(None)
            closed -= role(paths.pop().rpartition("/")[2]) < 0
        elif not closed and not value.isspace():
            texts.setdefault(blocks[-1], []).append(value)
            for path in set(paths):
                found[path][1] += len(value)
    for path, parts in texts.items():
        plain = " ".join(_NUMBER.sub("", html.unescape(" ".join(parts))).split())
        found[path][2] = _signed(xxhash.xxh64_intdigest(plain))
    order.append(None)
    return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def element_token(path: str) -> int:
    """Even; that of an end tag is its complement."""
    return xxhash.xxh64_intdigest(path) >> 2 << 1


def text_token(path: str, text: int) -> int:
    """Of a block and its text: odd."""
    return xxhash.xxh64_intdigest(f"{path}\n{text}") >> 2 << 1 | 1


def sequence(found: dict[str, list], order: list[str | None]) -> list[int]:
    """The page's tokens in order, of an outline: start tags, each with the text of its block behind it, and end tags."""
    start = {}
    for path, (_, _, text) in found.items():
        token = element_token(path)
        start[path] = (token,) if text is None else (token, text_token(path, text))
    tokens, ends = [], []
    for path in order:
        if path is None:
            tokens.append(ends.pop())
        else:
            tokens += start[path]
            ends.append(~start[path][0])
    return tokens


def text_in(source: str, slots: list[str], fixed: Iterable[str | int] = ()) -> str:
    """The text of the first of the named slots that has any on the page, or of the element that the page itself names best;
    where neither is there, of the whole page, without the blocks that are `fixed`, if that leaves any. Those are named by
    their paths, or by the token of their text."""
    events = page_events(source)
    have = outline(events)
    slot = next((s for s in slots if have.get(s, (0, 0))[1]), None)
    if slot is None:
        slot = next(iter(best_first([(p, v[1]) for p, v in have.items()])), "")
    if slot:
        return _text(events, slot, frozenset())
    fixed = frozenset(fixed)
    is_fixed = lambda path, text: path in fixed or (text is not None and text_token(path, text) in fixed)
    blocks = frozenset(path for path, (_, _, text) in have.items() if is_fixed(path, text)) if fixed else fixed
    return (blocks and _text(events, "", blocks)) or _text(events, "", frozenset())


def _text(events: list[tuple[str, str, str]], slot: str, fixed: frozenset[str]) -> str:
    done, parts = [], []
    paths, blocks, closed, depth = [""], [""], 0, 0
    # Inside an article its own header belongs to it.
    shut = _closed_inside if slot else lambda label: role(label) < 0

    def end_block():
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            done.append(text)

    for kind, tag, value in events:
        if kind == "open":
            paths.append(f"{paths[-1]}/{value}")
            blocks.append(paths[-1] if tag in BLOCK else blocks[-1])
            if paths[-1] == slot:
                depth += 1
            elif depth or not slot:
                closed += shut(value)
            if tag in BLOCK:
                end_block()
            elif tag == "br":
                parts.append(" ")
        elif kind == "close":
            path = paths.pop()
            blocks.pop()
            if tag in BLOCK:
                end_block()
            if path == slot:
                depth -= 1
            elif depth or not slot:
                closed -= shut(path.rpartition("/")[2])
        elif (depth or not slot) and not closed and blocks[-1] not in fixed:
            parts.append(value)
    end_block()
    return "\n".join(done)


def _closed_inside(label: str) -> bool:
    return role(label) < 0 and not label.startswith("header")


def _named(path: str) -> bool:
    """Whether the path ends in an element that says it is the article, and lies in no furniture."""
    labels = path.split("/")[1:]
    return bool(labels) and role(labels[-1]) == 2 and all(role(label) >= 0 for label in labels)


def best_first(paths: list[tuple[str, int]]) -> list[str]:
    """Of paths and the text in them, those named as the article: `article` and `main` before other names, then by text; of
    equal ones the outer."""
    named = [(p, n) for p, n in paths if n and _named(p)]
    says = lambda path: path.rpartition("/")[2].partition(".")[0] in ("article", "main")
    named.sort(key=lambda x: (not says(x[0]), -x[1], len(x[0]), x[0]))
    return [p for p, _ in named]


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: `page_id`, `url`, `text`, `n_chars`.

    A null html is empty and has no text. A page without a host (null url, no `://`) shares the template of all such
    pages. Repeated rows and null identifiers are extracted like others; other columns are ignored; an empty table gives an
    empty result. Of slots with equal text the outer counts, and of those the one whose path sorts first. Each page's text is in `text` in full: blocks in page order, joined by a line feed.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))
    pages = pages.withColumn("host", host)
    parsed = stored(pages.select("host", "html").mapInArrow(_parsed, _PARSED))
    templates = stored(_named_slots(parsed).join(fixed_texts(parsed), "host", "full"))
    placed = pages.join(templates, "host", "left").select("page_id", "url", "html", "slots", "fixed")
    kind = pages.schema["page_id"].dataType.simpleString()
    return placed.mapInArrow(_extracted, f"page_id {kind}, url string, text string, n_chars bigint")


_PARSED = "host string, page bigint, tokens array<bigint>, named array<struct<path: string, chars: bigint>>"


def _named_slots(parsed: DataFrame) -> DataFrame:
    """Per host, the paths that say they are the article, best first."""
    named = parsed.select("host", F.inline("named")).groupBy("host", "path")
    named = named.agg(F.count("*").alias("pages"), F.sum("chars").alias("chars")).where(F.col("pages") >= MIN_PAGES)
    # A group holds a few paths for each layout.
    return named.groupBy("host").applyInPandas(_ranked, "host string, slots array<string>")


def fixed_texts(parsed: DataFrame) -> DataFrame:
    """Per host, the tokens of the texts that are part of its template (`fixed`)."""
    classes = equivalence_classes(parsed)
    classes = _unbroken(parsed, classes, nested=False)
    classes = _unbroken(parsed, classes, nested=True)
    element = F.col("token") == F.col("block")
    texts = F.collect_list(F.when(~element, F.col("token"))).alias("texts")
    # A text that broke off its class alone is data.
    placed = classes.groupBy("host", "class").agg(F.max(element).alias("placed"), texts).where("placed and size(texts) > 0")
    return placed.groupBy("host").agg(F.flatten(F.collect_list("texts")).alias("fixed"))


def equivalence_classes(parsed: DataFrame) -> DataFrame:
    """The tokens of each host that are on enough pages: `host`, `class`, `token`, `block` (the token of the block that a text is
    of; that of an element is its own)."""
    tokens = parsed.select("host", "page", "tokens").mapInArrow(
        _folded, "host string, token bigint, block bigint, pages bigint, vector bigint, vector2 bigint, low bigint, high bigint"
    )
    tokens = tokens.groupBy("host", "token", "block").agg(
        *(F.sum(c).alias(c) for c in ("pages", "vector", "vector2")), F.min("low").alias("low"), F.max("high").alias("high")
    )
    # Pages that are copies of one page have no template.
    tokens = tokens.where((F.col("pages") >= MIN_PAGES) & (F.col("low") < F.col("high")))
    classes = tokens.select("host", F.xxhash64("vector", "vector2").alias("class"), "token", "block")
    # A class of texts alone has no place in a page.
    element = F.max(F.col("token") == F.col("block")).over(Window.partitionBy("host", "class"))
    return classes.withColumn("placed", element).where("placed").drop("placed")


def _unbroken(parsed: DataFrame, classes: DataFrame, nested: bool) -> DataFrame:
    """The classes, those broken up that are not ordered, or do not nest, on some page."""
    classes = stored(classes)
    # A few tokens for each layout.
    members = classes.groupBy("host").agg(F.collect_list(F.struct("token", "class")).alias("members"))
    found = parsed.select("host", "tokens").join(members, "host")
    found = found.mapInArrow(partial(_places, nested), "host string, class bigint, low array<bigint>, high array<bigint>")
    found = found.groupBy("host", "class").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    broken = found.where("low != high or size(low) = 0").select("host", "class", F.lit(True).alias("broken"))
    part = F.when(F.col("broken"), F.xxhash64("class", "block")).otherwise(F.col("class")).alias("class")
    return classes.join(broken, ["host", "class"], "left").select("host", part, "token", "block")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct([("path", pa.string()), ("chars", pa.int64())])))
    for batch in batches:
        rows = []
        for source in batch.column("html"):
            source, order = source.as_py(), []
            found = outline(page_events(source), order)
            named = [{"path": path, "chars": chars} for path, (_, chars, _) in found.items() if _named(path)]
            rows.append((_signed(xxhash.xxh64_intdigest(source.encode())), sequence(found, order), named))
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 3, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("host"), *columns], ["host", "page", "tokens", "named"])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per token: pages, the sums that stand for its vector, the least and greatest page."""
    sums: dict[tuple[str, int, int], list[int]] = {}
    names = ["host", "token", "block", "pages", "vector", "vector2", "low", "high"]

    def out():
        columns = list(zip(*((*key, *value) for key, value in sums.items()))) or [[]] * len(names)
        arrays = [pa.array(c, k) for c, k in zip(columns, (pa.string(), *[pa.int64()] * 7))]
        sums.clear()
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        for host, page, tokens in zip(*(batch.column(c) for c in ("host", "page", "tokens"))):
            host, page, tokens = host.as_py(), page.as_py(), tokens.values.to_numpy().tolist()
            hashes: dict[int, tuple[int, int]] = {}
            block_of = {token: tokens[i - 1] if token & 1 else token for i, token in enumerate(tokens) if token >= 0}
            for token, times in Counter(token for token in tokens if token >= 0).items():
                if times not in hashes:
                    whole = xxhash.xxh64_intdigest(f"{page} {times}")
                    hashes[times] = whole >> 32, whole & 0xFFFFFFFF  # whose sums stay in range
                entry = sums.setdefault((host, token, block_of[token]), [0, 0, 0, page, page])
                entry[0] += 1
                entry[1] += hashes[times][0]
                entry[2] += hashes[times][1]
                entry[3] = min(entry[3], page)
                entry[4] = max(entry[4], page)
            if len(sums) > FOLDED:
                yield out()
    yield out()


def places(tokens: list[int], class_of: dict[int, int], nested: bool) -> Iterator[tuple[int, list[int]]]:
    """Per class on the page: its tokens in order, or nothing if they come in no order; if `nested`, for each occurrence, behind
    the order, the class it lies in and how many tokens of that come before, or nothing if it overlaps another."""
    own: dict[int, list[int]] = {}
    for token in tokens:
        if (found := class_of.get(max(token, ~token))) is not None:
            own.setdefault(found, []).append(token)
    orders = {}
    for found, some in own.items():
        order = some[: len(set(some))]
        if order * (len(some) // len(order)) == some:
            orders[found] = order
        else:
            yield found, []
    if not nested:
        yield from orders.items()
        return
    open_in: list[list[int]] = []  # classes, with the number of their tokens so far
    crossed = set()
    for token in tokens:
        found = class_of.get(max(token, ~token))
        if (order := orders.get(found)) is None:
            continue
        if token == order[0]:
            yield found, [*order, *(open_in[-1] if open_in else (0, 0))]
            open_in.append([found, 1])
        else:
            if all(found != other for other, _ in open_in):
                continue  # overlapped by one before
            while open_in[-1][0] != found:
                crossed |= {found, open_in.pop()[0]}
            open_in[-1][1] += 1
        if open_in[-1][1] == len(order):
            open_in.pop()
    for found in crossed:
        yield found, []


def _places(nested: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class, the least and greatest of its places."""
    folded: dict[tuple[str, int], list[list[int]]] = {}
    classes: dict[str, dict[int, int]] = {}
    kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def out():
        columns = list(zip(*((*key, *value) for key, value in folded.items()))) or [[]] * 4
        folded.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "class", "low", "high"])

    for batch in batches:
        hosts, members = batch.column("host").to_pylist(), batch.column("members")
        for i, tokens in enumerate(batch.column("tokens")):
            if (class_of := classes.get(hosts[i])) is None:
                if len(classes) >= HOSTS:
                    classes.clear()
                token, found = members[i].values.flatten()
                class_of = classes[hosts[i]] = dict(zip(token.to_pylist(), found.to_pylist()))
            for found, place in places(tokens.values.to_numpy().tolist(), class_of, nested):
                entry = folded.setdefault((hosts[i], found), [place, place])
                entry[:] = min(entry[0], place), max(entry[1], place)
            if len(folded) > FOLDED:
                yield out()
    yield out()


def _ranked(paths: pd.DataFrame) -> pd.DataFrame:
    slots = best_first([(p, n) for p, n in zip(paths["path"], paths["chars"])])
    return pd.DataFrame({"host": [paths["host"].iloc[0]], "slots": [slots]})


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots, fixed = (batch.column(c).to_pylist() for c in ("slots", "fixed"))
        texts = [text_in(source.as_py(), s or [], f or []) for source, s, f in zip(batch.column("html"), slots, fixed)]
        arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
        arrays.append(pa.array([len(t) for t in texts], pa.int64()))
        yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])
