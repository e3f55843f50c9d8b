"""Main text of web pages by each host's nested template and its slots.

A page is read as tokens: tags with the path of containers around them, and
whole text blocks with their path and place.  Tokens of a host with the same
occurrence vector (how often on each page) and the same parent form an
equivalence class; vectors are compared by a 64-bit sum over pages, so classes
come from partial aggregation and no host is ever held in one task.  Classes
of at least two tags that stand on at least half of the host's pages are put in
the order of their tags and located on every page: a class is valid if its
tags come in that order in each of its occurrences, cross no stronger class,
and lie between the same tags of the enclosing class on all pages.  The valid
classes, one within another, are the host's template; what lies between two
neighbouring tags of a class is a slot.

Text belongs to the innermost slot around it.  Names choose among slots: the
main ones are those inside an article (or main) container, or else those of
the container whose slots hold most text outside links (several where layouts
differ; the one with most text on the page is taken); menus, headers, footers,
sidebars, notices, adverts, forms and reader comments, known by tag or class
name, are never part of it.  Text that the template repeats outside the
article is dropped too; copies of a page count once there.  Blocks of the main
slots are kept whole, in page order.

Scale: three scans, and a count of contents by hash that keeps the repeated
ones only.  The first two shuffle one row per slice, host and token or slot;
the template has a few rows per host and is joined by host to the pages
(broadcast only while the planner finds it small).

Defined results: null and empty pages give an empty text; pages whose host
has no template (a lone page, or none of its tags shared), or without text in
its main slots, are read with the tags of the page itself; a null url is a
host of its own; repeated rows are treated alike; other columns are ignored.
"""
from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stage_table

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
                    r"<(script|style|noscript|template|svg|iframe|textarea|select|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|"
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CONTAINERS = set("html body div section article main nav header footer aside form ul ol dl table tbody tr td th "
                  "figure blockquote details dialog fieldset button".split())
_INLINE = set("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike "
              "strong sub sup time tt u var wbr img".split())
_NEVER = set("nav header footer aside form dialog button fieldset head".split())
_NEVER_NAMED = re.compile(r"(?:^|[-_\s])(?:nav(?:bar|igation)?|menu|header|footer|sidebar|side|ads?|advert\w*|"
                          r"sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|"
                          r"comments?|respond|replies|share|social|related|breadcrumbs?|login|search)(?:$|[-_\s])",
                          re.I)
_MAIN = ("article", "main")


def read_page(page: str | None):
    """(tags, blocks): tag tokens in order, ``path/name`` where one opens and
    ``path//name`` where it closes; blocks (path, inside the article, barred,
    text, characters inside links, number of tags before)."""
    tags, blocks, stack, text, link = [], [], [], [], 0
    path, barred, inside, at, linked = "", 0, 0, 0, 0

    def flush():
        nonlocal text, linked
        if text:
            t = " ".join(entities.unescape("".join(text)).split())
            if t:
                blocks.append((path, inside > 0, barred > 0, t, linked, len(tags)))
        text, linked = [], 0
    page = page or ""
    for m in _TOKEN.finditer(page):
        piece = page[at:m.start()]
        at = m.end()
        if piece:
            text.append(piece)
            linked += len(piece) if link else 0
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            link = 0 if m[2] else 1
        if name in _INLINE:
            continue
        flush()
        if not m[2]:
            named = [(k.lower(), (a or b or c).lower()) for k, a, b, c in _NAMES.findall(m[4])]
            names = " ".join(v for _, v in named if v)
            token = f"{path}/{name}"
            if name in _CONTAINERS and not m[4].endswith("/"):
                stop = name in _NEVER and not (name == "header" and inside) or bool(_NEVER_NAMED.search(names))
                main = name in _MAIN
                stack.append((name, path, stop, main))
                kind = " ".join(v for k, v in named if v and k != "id").replace("/", "_")  # ids differ by page
                path = token = token + (f".{kind}" if kind else "")
                barred += stop
                inside += main
            tags.append(token)
        else:
            token = f"{path}//{name}"
            if any(s[0] == name for s in stack):
                while True:
                    top, before, stop, main = stack.pop()
                    token, path = f"{before}/{path[len(before):]}", before
                    barred -= stop
                    inside -= main
                    if top == name:
                        break
            tags.append(token)
            link = 0
    if at < len(page):
        text.append(page[at:])
        linked += len(page) - at if link else 0
    flush()
    return tags, blocks


def host_of(url: str | None) -> str | None:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else None


def _text_token(path: str, text: str) -> str:
    return f"{path}\x00{xxhash.xxh64_hexdigest(text.encode('utf-8', 'surrogatepass'))}"


def _vector_part(page: int, count: int) -> int:
    return xxhash.xxh64_intdigest(f"{page}:{count}".encode()) >> 8


def container_of(token: str) -> str:
    """Path of the container that the place right after a tag lies in."""
    parent, name = token.rstrip("/").rsplit("/", 1)
    closes = parent.endswith("/")
    return token if not closes and name.split(".", 1)[0] in _CONTAINERS else parent.removesuffix("/")


def in_main(path: str) -> bool:
    return any(e.split(".", 1)[0] in _MAIN for e in path.split("/"))


def locate(tags: list[str], classes: list[list[str]]):
    """(chains, parents): for each number of tags passed the slots (class,
    gap) around that place, outermost first; and for each class that is
    ordered and nested on the page, the chain that all of it lies in (None:
    it is not, or lies in several).  Stronger classes come first."""
    place = {t: (c, i) for c, tokens in enumerate(classes) for i, t in enumerate(tokens)}
    marks = [place.get(t) for t in tags]
    parents: dict = {}
    while True:
        chains, stack, found, wrong = [()], [], {}, None
        for mark in marks:
            if mark is None or mark[0] in parents:
                chains.append(chains[-1])
                continue
            c, i = mark
            depth = next((k for k, s in enumerate(stack) if s[0] == c), None)
            if i == 0 and depth is None:
                found.setdefault(c, set()).add(chains[-1])
                stack.append((c, 0))
            elif i and stack and stack[-1] == (c, i - 1):
                stack[-1] = (c, i)
                if i == len(classes[c]) - 1:
                    stack.pop()
            else:                                        # out of order, or across the classes opened since
                across = [s[0] for s in stack[depth + 1:]] if depth is not None and stack[depth] == (c, i - 1) else []
                wrong = max([c, *across])
                break
            chains.append(tuple(stack))
        else:
            wrong = max((s[0] for s in stack), default=None)      # not ended on the page
        if wrong is None:
            return chains, parents | {c: next(iter(p)) if len(p) == 1 else None for c, p in found.items()}
        parents[wrong] = None


def _chain(slots) -> str:
    return "/".join(f"{c}.{g}" for c, g in slots)


def nest(classes: list[list[str]], pages: int, found: list) -> tuple[list, list, list]:
    """(valid classes, slots inside an article, other slots by container, best
    first) of a host, from what ``locate`` found on its pages: (kind, key,
    pages, chars, low, high) of classes (1: pages where it is not valid, least
    and greatest chain around it) and of slots (2: their text)."""
    wrong = {int(f["key"]) for f in found if f["kind"] == 1 and (f["pages"] > 0 or f["low"] != f["high"])}
    seen = {int(f["key"]) for f in found if f["kind"] == 1}
    valid = {c: n for n, c in enumerate(c for c in range(len(classes)) if c in seen - wrong)}
    slots = {f"{n}.{g}": container_of(t) for c, n in valid.items() for g, t in enumerate(classes[c][:-1])}
    text: dict = defaultdict(lambda: [0, 0])             # pages and characters by container
    for f in found:
        chain = [s.split(".") for s in f["key"].split("/") if s] if f["kind"] == 2 else []
        inner = next((f"{valid[int(c)]}.{g}" for c, g in reversed(chain) if int(c) in valid), None)
        if inner and f["chars"] > 0:
            t = text[slots[inner]]
            t[0], t[1] = max(t[0], f["pages"]), t[1] + f["chars"]
    mean = {p: n / max(k, 1) for p, (k, n) in text.items() if not in_main(p) and 10 * k >= pages}
    least = max(mean.values(), default=0) / 2
    best = sorted((p for p in mean if mean[p] >= least), key=lambda p: (-mean[p], p))
    # the page's frame is no container of its own: only what lies between its tags directly
    frame = {p for p in best if {e.split(".", 1)[0] for e in p.split("/")} <= {"", "html", "body"}}
    groups = [[s for s, at in slots.items() if at == p or p not in frame and at.startswith(f"{p}/")] for p in best]
    return [classes[c] for c in valid], [s for s, at in slots.items() if in_main(at)], groups


def _tokens(pages: DataFrame) -> DataFrame:
    """(host, token, kind, pages, vector, first): tags (kind 1) with the sum
    of their first places, repeated texts (2) and the host itself (0)."""
    def count(batch):
        parts: dict = defaultdict(lambda: defaultdict(lambda: [0, 0, 0, 0]))  # pages, vector, kind, first place
        for url, page, rid, copies in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 3))):
            seen = parts[copies]
            host = host_of(url)
            tags, blocks = read_page(page)
            if not tags:
                continue
            seen[host, ""][0] += 1
            first = dict(zip(reversed(tags), range(len(tags) - 1, -1, -1)))
            for token, n in Counter(tags).items():
                s = seen[host, token]
                s[0] += 1
                s[1] += _vector_part(rid, n)
                s[2] = 1
                s[3] += first[token]
            for token, n in Counter(_text_token(b[0], b[3]) for b in blocks if not b[1]).items():
                s = seen[host, token]
                s[0] += 1
                s[1] += _vector_part(rid, n)
                s[2] = 2
        keys = [(*k, c) for c, seen in parts.items() for k in seen]
        rows = [r for seen in parts.values() for r in seen.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] & (2 ** 62 - 1) for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64()),
             pa.array([k[2] for k in keys], pa.int64())],
            ["host", "token", "pages", "vector", "kind", "first", "copies"])
    rows = map_batches(pages.select("url", "html", "rid", "copies"), count,
                       "host string, token string, pages long, vector long, kind int, first long, copies long")
    return stage_table(rows.groupBy("host", "token", "kind").agg(
        _once("pages"), F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"), _once("first")), "tokens")


def _once(c: str):
    """Sum over contents: copies are alike."""
    return F.round(F.sum(F.col(c) / F.col("copies"))).cast("long").alias(c)


def templates(pages: DataFrame) -> DataFrame:
    """(host, classes, main, groups, texts): the nested classes of tags, the
    slots inside an article, the other main slots, best first, and the hashes
    of repeated texts; one row per host that has a template.  ``copies`` is
    how many rows of the host have the page's content: each content counts as
    one page."""
    tokens = _tokens(pages)
    size = tokens.where("kind = 0").select(F.col("host").alias("_host"), F.col("pages").alias("all"))
    known = tokens.where("kind > 0").join(size, F.col("host").eqNullSafe(F.col("_host"))).where(
        "pages >= 2 AND 2 * pages >= all")
    parent = F.regexp_replace("token", "//?[^/]*$", "")
    classes = known.where("kind = 1").groupBy("host", "vector", parent.alias("parent")).agg(
        F.first("all").alias("all"), F.first("pages").alias("pages"),
        F.sort_array(F.collect_list(F.struct("first", "token")))["token"].alias("tags")).where("size(tags) >= 2")
    classes = classes.groupBy("host").agg(F.first("all").alias("all"), F.sort_array(F.collect_list(F.struct(
        (-F.col("pages")).alias("pages"), F.length("parent").alias("depth"), "tags")))["tags"].alias("classes"))
    texts = known.where("kind = 2").groupBy(F.col("host").alias("_h")).agg(F.collect_set("token").alias("texts"))
    hosts = stage_table(classes.join(texts, F.col("host").eqNullSafe(F.col("_h")), "left").select(
        "host", "all", "classes", F.coalesce("texts", F.array().cast("array<string>")).alias("texts")), "classes")

    def find(batch):
        parts: dict = {}                                 # pages, characters, least and greatest chain
        for host, page, copies, classes, texts in zip(*(batch.column(k).to_pylist() for k in range(5))):
            tags, blocks = read_page(page)
            if not tags:
                continue
            chains, parents = locate(tags, classes)
            for c, chain in parents.items():
                at = "" if chain is None else _chain(chain)
                s = parts.setdefault((host, 1, str(c), copies), [0, 0, at, at])
                s[0] += chain is None
                s[2], s[3] = min(s[2], at), max(s[3], at)
            texts, held = set(texts), Counter()
            for b in blocks:
                if not b[2] and (b[1] or _text_token(b[0], b[3]) not in texts):
                    held[_chain(chains[b[5]])] += max(len(b[3]) - b[4], 0)
            for chain, n in held.items():
                s = parts.setdefault((host, 2, chain, copies), [0, 0, "", ""])
                s[0] += 1
                s[1] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[j] for k in parts], t) for j, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.int64()))]
            + [pa.array([s[j] for s in parts.values()], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.string(),
                                                                                 pa.string()))],
            ["host", "kind", "key", "copies", "pages", "chars", "low", "high"])
    on = hosts.withColumnRenamed("host", "_host")
    located = map_batches(pages.join(on, F.col("host").eqNullSafe(F.col("_host"))).select(
        "host", "html", "copies", "classes", "texts"), find,
        "host string, kind int, key string, copies long, pages long, chars long, low string, high string")
    found = located.groupBy("host", "kind", "key").agg(
        _once("pages"), _once("chars"), F.min("low").alias("low"), F.max("high").alias("high")).groupBy(
        F.col("host").alias("_h")).agg(F.collect_list(F.struct("kind", "key", "pages", "chars", "low", "high")).alias("found"))

    def build(batch):
        host, pages, classes, texts, found = (batch.column(k) for k in range(5))
        rows = [nest(c, n, f) for n, c, f in zip(pages.to_pylist(), classes.to_pylist(), found.to_pylist())]
        many = pa.list_(pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays(
            [host, pa.array([r[0] for r in rows], many), pa.array([r[1] for r in rows], pa.list_(pa.string())),
             pa.array([r[2] for r in rows], many), texts], ["host", "classes", "main", "groups", "texts"])
    return map_batches(hosts.join(found, F.col("host").eqNullSafe(F.col("_h"))).select(
        "host", "all", "classes", "texts", "found"), build,
        "host string, classes array<array<string>>, main array<string>, groups array<array<string>>, texts array<string>")


def main_text(page: str | None, classes: list, main: set, groups: list, texts: set) -> str:
    """Blocks of the page's main slots, one a line: those inside the template's
    article, or else of the host's container with most text here, or else of
    the page's own largest."""
    tags, blocks = read_page(page)
    chains = locate(tags, classes)[0]
    slot = [next((f"{c}.{g}" for c, g in reversed(chains[b[5]])), None) for b in blocks]
    article = [b for b, s in zip(blocks, slot) if s in main and not b[2]] or [b for b in blocks if b[1] and not b[2]]
    if article or main and any(b[1] for b in blocks):
        return "\n".join(b[3] for b in article)
    plain = [(b, s) for b, s in zip(blocks, slot) if not b[2] and _text_token(b[0], b[3]) not in texts]
    held: Counter = Counter()
    total: Counter = Counter()
    for b, s in plain:
        n = max(len(b[3]) - b[4], 0)
        held[s] += n
        total[b[0]] += n
    best = max(groups, key=lambda g: sum(held[s] for s in g), default=[])     # the host's first, if equal
    if any(held[s] > 0 for s in best):
        return "\n".join(b[3] for b, s in plain if s in best)
    if not total:
        return ""
    own = max(total, key=lambda p: (total[p], p))
    return "\n".join(b[3] for b, _ in plain if b[0] == own or b[0].startswith(f"{own}/"))


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    src = pages.select(F.col(f"`{page_id}`").alias("id"), F.col(f"`{url}`").alias("url"),
                       F.col(f"`{html}`").alias("html"))
    name = F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    keyed = src.withColumn("host", F.when(F.col("url").rlike(r"^(?:[a-zA-Z][\w+.-]*:)?//"), name))
    content = keyed.withColumns({"_h": F.xxhash64("host"), "_c": F.xxhash64("html")})
    again = content.groupBy("_h", "_c").agg(F.count("*").alias("copies")).where("copies > 1")
    again = stage_table(again, "copies")
    found = templates(content.join(again, ["_h", "_c"], "left").select(
        "host", "url", "html", F.coalesce(F.xxhash64("id"), F.lit(0)).alias("rid"),
        F.coalesce("copies", F.lit(1)).alias("copies")))
    hosts = stage_table(found, "templates").withColumnRenamed("host", "_host")
    both = keyed.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left").select(
        "id", "url", "html", "classes", "main", "groups", "texts")

    def run(batch):
        texts = [main_text(h, c or [], set(m or ()), g or [], set(t or ())) for h, c, m, g, t in zip(
            *(batch.column(k).to_pylist() for k in (2, 3, 4, 5, 6)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         ["id", "url", "text", "n_chars"])
    kind = src.schema["id"].dataType.simpleString()
    return map_batches(both, run, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", page_id)
