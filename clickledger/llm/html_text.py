"""Operator 6: main text of web pages, with suffix arrays over each host.

A page is cut into blocks by its markup; blocks inside elements that are never the main text (menus, headers,
footers, sidebars, forms) or whose class names adverts, notices or readers' comments are dropped. Where pages mark
their article, the host decides inside the marked part; where they mark none, it decides on the whole page: the token
streams of pages are concatenated and their suffixes sorted to a depth of RUN tokens by prefix doubling. A token is in a repeated substring of
RUN tokens or more exactly if it is in one of RUN tokens, so this depth finds all long ones. Runs are counted by the
distinct pages of the host that have them, over all arrays; those on MIN_PAGES or more are boilerplate. Pages with the same longest block are
copies of one article and count once, so that an article's copies do not make it boilerplate: what surrounds a run must differ.
Covered runs are removed and unique runs stay. Blocks shorter than a run are named whole; repeated ones go if they are part of
a stretch of repeated blocks at the page's edge or next to a long run, so that a heading between unique paragraphs stays.

Inside marked articles long runs go that the host has both as boilerplate, in what the marks reject on MIN_PAGES pages or more, and inside MIN_PAGES articles:
a line that only articles share is theirs, and a teaser stands inside its own article alone. Again copies count once, and where such runs cover COPIED of an
article or more, all of it stays.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.common import give_back, stored

#: A suffix array takes up to this many pages of a host and about so many tokens, and a task holds that many tokens of unfinished arrays.
#: These bound the work units; what counts as boilerplate does not depend on them.
PAGES = 400
ARRAY_TOKENS = 500_000
HELD_TOKENS = 1_000_000
#: Runs of a host that one group adds up, on average.
GROUP_RUNS = 300_000
#: Shortest substring that counts as repeated, in tokens, a power of two, and the distinct pages that must have it.
RUN = 16
MIN_PAGES = 3
#: Part of a block's tokens under repeated runs from which on nothing of the block stays.
COVERED = 0.8
#: Part of a marked article under repeated runs from which on all of it stays.
COPIED = 0.5
#: Part of a block that must be links for it to be one of a menu, and blocks of a menu.
LINKED, LINKS = 0.8, 3
#: Pages of a host that one slice of the last step has, on average; a slice reads all repeated runs of its host.
SLICE_PAGES = 4096
#: The same for marked articles, which get only what is boilerplate outside of articles.
ARTICLE_SLICE = 512

#: Element names of HTML.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp")
NOISE = frozenset("nav header footer aside form menu dialog button select svg math object applet canvas audio video figure-ad head".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role values that mark adverts, notices and readers' comments inside a marked article.
NOISE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promo(?:tion|tions|ted)?|cookies?|gdpr|cookie-?notice|newsletter|subscribe|sidebars?|navbar|navigation|breadcrumbs?|comments?|commentlist|disqus|share|sharing|popup|modal|complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
MAIN_WORDS = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|article-body|post-content|entry-content|main-content)(?:$|[\s_-])", re.I)

_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_MARK = re.compile(r"""<!--(?:>|->|.*?(?:-->|--!>|\Z))|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.I)


class Block:
    __slots__ = ("article", "linked", "noise", "region", "text")

    def __init__(self, text: str, noise: bool, article: bool, region: bool, linked: bool = False):
        self.text, self.noise, self.article, self.region = text, noise, article, region
        self.linked = linked  # most of it is the text of links


def _attributes(tag: str) -> tuple[bool, bool]:
    """(noise, main content) by class, id, role and hidden."""
    noise = main = False
    for name, a, b, c in _ATTR.findall(tag):
        value = a or b or c
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            noise = True
        elif value and name != "aria-hidden":
            noise |= bool(NOISE_WORDS.search(value))
            main |= bool(MAIN_WORDS.search(value))
    return noise, main


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, with the markup's verdicts; character references decoded, white space made single, trimmed, empty ones left out."""
    out: list[Block] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, noise, article, region of the open elements that matter
    noise = article = region = link = False
    linked = 0  # characters of links in parts

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            mostly, linked = linked >= LINKED * len(text.strip()), 0
            parts.clear()
            text = " ".join((_html.unescape(text) if "&" in text else text).split())
            if text:
                out.append(Block(text, noise, article, region, mostly))

    at, end = 0, len(page)
    while at < end:
        m = _MARK.search(page, at)
        if m is None:
            rest = page[at:]
            cut = re.search(r"<[A-Za-z/!][^<]*\Z", rest)  # a tag that the page's end cuts off
            parts.append(rest[: cut.start()] if cut else rest)
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
            linked += (m.start() - at) * link
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        closing, tag = m.group(1), m.group(3)
        if name == "a":
            link = not closing
        if not closing:
            if name in _RAW_END and not tag.endswith("/"):
                e = _RAW_END[name].search(page, at)
                at = e.end() if e else end
                if name in BLOCKS:
                    flush()
                continue
            if name in BLOCKS:
                flush()
            elif name == "br":
                parts.append(" ")
            if name in VOID:
                continue
            n, main = _attributes(tag) if tag else (False, False)
            if name == "body" or name == "html":
                continue
            n = (n and name not in ("article", "main")) or name in NOISE
            a, r = name == "article", name == "main" or main
            if n or a or r or (stack and name in ("div", "section", stack[-1][0])):
                stack.append((name, noise, article, region))
                noise, article, region = noise or n, article or (a and not noise), region or (r and not noise)
        else:
            if name in BLOCKS:
                flush()
            elif name == "p" or name == "br":
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    _, noise, article, region = stack[i]
                    del stack[i:]
                    break
            else:
                if name in ("body", "html") and stack:
                    _, noise, article, region = stack[0]
                    stack.clear()
    flush()
    return out


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x * np.uint64(0x9E3779B97F4A7C15) + y
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Stream:
    """A page's token numbers on end, the number of tokens of each block, and a number for each whole block."""

    def __init__(self, texts: list[str]):
        words = [t.split(" ") for t in texts]
        self.words = words
        self.tokens = np.array([xxhash.xxh3_64_intdigest(w) for ws in words for w in ws], np.uint64)
        self.size = np.array([len(ws) for ws in words], np.int64)
        self.blocks = np.array([xxhash.xxh3_64_intdigest(t, 1) for t in texts], np.uint64)

    def names(self) -> np.ndarray:
        """The runs that the page has: substrings of RUN tokens, and whole blocks that are shorter."""
        at, name = run_names(self.tokens, np.zeros(len(self.tokens), np.int64))
        return np.concatenate([name, self.blocks[self.size < RUN]])


def signature(texts: list[str]) -> int:
    """What copies of one article share: a number of the longest block, the first of equal ones."""
    return xxhash.xxh3_64_intdigest(max(texts, key=len)) - (1 << 63) if texts else 0


def run_names(stream: np.ndarray, page: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(positions where a run of `run` tokens starts, 64-bit names of these runs), by prefix doubling; a run never leaves its page.

    Names are hashes of the run's tokens alone, so that a run has the same name in every array.
    """
    name, width = stream.astype(np.uint64), 1
    while width < run and len(name) > width:
        name, width = _mix(name[:-width], name[width:]), width * 2
    if width < run:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(page[: len(name)] == page[run - 1 :])
    return at, name[at]


def run_pages(name: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct names in order, distinct pages that have each), by sorting the suffixes that `name` names."""
    order = np.lexsort((page, name))  # the suffix array, to that depth
    r, p = name[order], page[order]
    new = np.ones(len(order), bool)
    new[1:] = (r[1:] != r[:-1]) | (p[1:] != p[:-1])
    return np.unique(r[new], return_counts=True)


def _covered(n: int, start: np.ndarray, run: int) -> np.ndarray:
    """Which of n tokens lie in a run that starts at one of the positions."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + run, -1)
    return np.cumsum(edge[:n]) > 0


def repeated_positions(stream: np.ndarray, page: np.ndarray, run: int = RUN, pages: int = MIN_PAGES) -> np.ndarray:
    """Which tokens lie in a run of `run` tokens that stands on at least `pages` distinct pages of one array.

    stream: token numbers of all pages on end, page: whose they are.
    """
    at, name = run_names(stream, page, run)
    names, count = run_pages(name, page[at])
    return _covered(len(stream), at[np.isin(name, names[count >= pages])], run)


def _menus(bs: list[Block]) -> list[bool]:
    """Which blocks of a page without marks are noise by markup: noise elements, and LINKS or more short blocks of links in a row."""
    out = [x.noise for x in bs]
    i = 0
    while i < len(bs):
        j = i
        while j < len(bs) and bs[j].linked and bs[j].text.count(" ") < RUN:
            j += 1
        if j - i >= LINKS:
            out[i:j] = [True] * (j - i)
        i = max(j, i + 1)
    return out


def _by_mark(bs: list[Block]) -> list[bool] | None:
    """Which blocks a page's own marks keep; None where it marks neither an article nor a main part."""
    if any(b.article for b in bs):
        return [b.article and not b.noise for b in bs]
    if any(b.region and not b.noise for b in bs):
        return [b.region and not b.noise for b in bs]
    return None


def _among(name: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    where = np.searchsorted(ordered, name)
    hit = np.zeros(len(name), bool)
    inside = where < len(ordered)
    hit[inside] = ordered[where[inside]] == name[inside]
    return hit


def open_text(texts: list[str], noise: list[bool], repeated: np.ndarray) -> str:
    """The main text of a page without marks, given the names of the host's repeated runs in order."""
    s = Stream(texts)
    at, name = run_names(s.tokens, np.zeros(len(s.tokens), np.int64))
    covered = _covered(len(s.tokens), at[_among(name, repeated)], RUN)
    short = (s.size < RUN) & _among(s.blocks, repeated)
    ends = np.concatenate([[0], np.cumsum(s.size)])
    kept: list[str | None] = []
    for i, words in enumerate(s.words):
        under = covered[ends[i] : ends[i + 1]]
        kept.append(None if noise[i] or under.sum() >= COVERED * len(words) else " ".join(w for w, c in zip(words, under.tolist(), strict=True) if not c) if under.any() else texts[i])
    i = 0
    while i < len(texts):  # stretches of repeated short blocks and of dropped ones
        j = i
        while j < len(texts) and (short[j] or kept[j] is None):
            j += 1
        if j > i and (i == 0 or j == len(texts) or any(kept[x] is None for x in range(i, j))):
            kept[i:j] = [None] * (j - i)
        i = max(j, i + 1)
    return "\n".join(t for t in kept if t)


class _Arrays:
    """The unfinished suffix arrays of a task, one per host; a finished one is (host, names, pages)."""

    def __init__(self, pages: int):
        self.pages, self.held, self.done = pages, 0, []
        self.open: dict[str, tuple[list[np.ndarray], list[int]]] = {}  # names by page, names so far

    def add(self, host: str, texts: list[str]) -> None:
        names = Stream(texts).names()
        streams, size = self.open.setdefault(host, ([], [0]))
        streams.append(names)
        size[0] += len(names)
        self.held += len(names)
        if len(streams) >= self.pages or size[0] >= ARRAY_TOKENS:
            self._finish(host)
        elif self.held >= HELD_TOKENS or len(self.open) > HELD_TOKENS // 100:
            self.finish()

    def _finish(self, host: str) -> None:
        streams, size = self.open.pop(host)
        self.held -= size[0]
        self.done.append((host, *run_pages(np.concatenate(streams), np.repeat(np.arange(len(streams)), [len(x) for x in streams]))))

    def finish(self) -> None:
        for host in list(self.open):
            self._finish(host)

    def taken(self) -> list[tuple[str, np.ndarray, np.ndarray]]:
        done, self.done = self.done, []
        return done


_RUNS = "_host string, _names binary, _pages binary"


def _batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(schema)], names=[n for n, _ in schema])


def _first_pass(plain: DataFrame, kind: str) -> DataFrame:
    """A page with the long runs of what its marks reject, or without marks with its blocks; and the signature of each page's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            outside, parts, noise, signs = [], [], [], []
            for i in range(len(b)):
                bs = blocks(b.column(3)[i].as_py() or "")
                keep = _by_mark(bs) if bs else []
                body = [x.text for x in bs]
                outside.append(None if keep is None else long_runs([t for t, k in zip(body, keep, strict=True) if not k]).astype("<u8").tobytes())
                parts.append(body if keep is None else None)
                noise.append(_menus(bs) if keep is None else None)
                signs.append(signature(body))
            columns = [pa.array(outside, pa.binary()), pa.array(parts, pa.list_(pa.string())), pa.array(noise, pa.list_(pa.bool_())), pa.array(signs, pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *columns], names=["_host", "_key", "_url", "_outside", "_blocks", "_noise", "_sign"])
            give_back()

    return plain.select("_host", "_key", "_url", "_html").mapInArrow(run, f"_host string, _key {kind}, _url string, _outside binary, _blocks array<string>, _noise array<boolean>, _sign bigint")


def _marked_blocks(plain: DataFrame) -> DataFrame:
    """(_host, _sign, _blocks) of the pages that mark their article."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, page in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                bs = blocks(page.as_py() or "")
                if bs and _by_mark(bs) is not None:
                    rows.append((host, signature(body := [x.text for x in bs]), body))
            yield _batch([("_host", pa.string()), ("_sign", pa.int64()), ("_blocks", pa.list_(pa.string()))], rows)

    return plain.select("_host", "_html").mapInArrow(run, "_host string, _sign bigint, _blocks array<string>")


def _runs(pages_of: DataFrame, pages: int) -> DataFrame:
    """(_host, _names, _pages): the runs of pages (_host, _blocks), added up over each array."""
    schema = [("_host", pa.string()), ("_names", pa.binary()), ("_pages", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _Arrays(pages)
        out = lambda: _batch(schema, [(h, n.astype("<u8").tobytes(), c.astype("<u4").tobytes()) for h, n, c in arrays.taken()])
        for b in batches:
            for host, texts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                arrays.add(host, texts)
            yield out()
            give_back()
        arrays.finish()
        yield out()

    return pages_of.select("_host", "_blocks").mapInArrow(run, _RUNS)


def _repeated(runs: DataFrame, parts: int, group_runs: int) -> DataFrame:
    """(_host, _names): the runs that stand on at least MIN_PAGES pages of their host, in pieces.

    A host's runs are dealt by name into groups, so that a large host is many groups, and each adds up the pages of its names.
    """
    groups = runs.groupBy("_host").agg(F.ceil(F.sum(F.octet_length("_names")) / (8 * group_runs)).cast("int").alias("_groups"))
    dealt_schema = [("_host", pa.string()), ("_names", pa.binary()), ("_pages", pa.binary()), ("_group", pa.int64())]

    def columns(b: pa.RecordBatch, *names: str) -> Iterator[tuple]:
        return zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in names), strict=True)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for host, names, counts, n in columns(b, "_host", "_names", "_pages", "_groups"):
                names, counts = np.frombuffer(names, "<u8"), np.frombuffer(counts, "<u4")
                home = (names % np.uint64(max(1, n))).astype(np.int64)
                order = np.argsort(home, kind="stable")
                which, start = np.unique(home[order], return_index=True)
                if len(which):
                    yield _batch(dealt_schema, [(host, names[x].tobytes(), counts[x].tobytes(), int(g)) for g, x in zip(which, np.split(order, start[1:]), strict=True)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def answer() -> pa.RecordBatch:
            every, at = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([x[1] for x in held]), minlength=len(every))
            found = every[total >= MIN_PAGES]
            return _batch([("_host", pa.string()), ("_names", pa.binary())], [(now[0], found.tobytes())] if len(found) else [])

        for b in batches:
            for host, names, counts, group in columns(b, "_host", "_names", "_pages", "_group"):
                if (host, group) != now:
                    if held:
                        yield answer()
                    now, held = (host, group), []
                held.append((np.frombuffer(names, "<u8"), np.frombuffer(counts, "<u4")))
            give_back()
        if held:
            yield answer()

    dealt = runs.join(groups, "_host").mapInArrow(deal, _RUNS + ", _group bigint")
    return dealt.repartition(parts, "_host", "_group").sortWithinPartitions("_host", "_group").mapInArrow(add, "_host string, _names binary")


def article_text(text: str, repeated: np.ndarray) -> str:
    """A marked article without the host's repeated runs, given their names in order."""
    s = Stream(text.split("\n"))
    at, name = run_names(s.tokens, np.zeros(len(s.tokens), np.int64))
    covered = _covered(len(s.tokens), at[_among(name, repeated)], RUN)
    if not covered.any() or covered.sum() >= COPIED * len(covered):
        return text
    kept = []
    for ws, under in zip(s.words, np.split(covered, np.cumsum(s.size)[:-1]), strict=True):
        if under.sum() < COVERED * len(ws):
            kept.append(" ".join(w for w, c in zip(ws, under.tolist(), strict=True) if not c))
    return "\n".join(kept)


def long_runs(texts: list[str]) -> np.ndarray:
    """The distinct names of the runs of RUN tokens in blocks on end."""
    s = Stream(texts)
    return np.unique(run_names(s.tokens, np.zeros(len(s.tokens), np.int64))[1])


def _told_first(pages_of: DataFrame, names: DataFrame, slices: DataFrame, parts: int) -> DataFrame:
    """Pages (_host, _row, text and more) of hosts and the hosts' names (_host, _names), dealt so that a slice of a host's pages follows the host's names.

    slices: (_host, _slices) of the hosts with more than one slice, which are few.
    """
    n = F.coalesce("_slices", F.lit(1))
    asked = pages_of.join(F.broadcast(slices), "_host", "left").withColumn("_slice", F.pmod(F.xxhash64("_row"), n).cast("int")).drop("_slices", "_row")
    told = names.join(F.broadcast(slices), "_host", "left").select("_host", "_names", F.explode(F.sequence(F.lit(0), n - 1)).alias("_slice"))
    return asked.unionByName(told, allowMissingColumns=True).repartition(parts, "_host", "_slice").sortWithinPartitions("_host", "_slice", F.col("_names").isNull())


def _after_names(b: pa.RecordBatch, state: list) -> Iterator[tuple[int, str, np.ndarray]]:
    """(row, host, the host's names in order) of the pages of a batch of _told_first; state goes from batch to batch: slice, names, names in order."""
    columns = [b.column(b.schema.get_field_index(n)) for n in ("_host", "_slice", "_names")]
    for i, at in enumerate(zip(columns[0].to_pylist(), columns[1].to_pylist(), strict=True)):
        if not state or at != state[0]:
            state[:] = [at, [], None]
        if columns[2][i].is_valid:
            state[1].append(np.frombuffer(columns[2][i].as_py(), "<u8"))
            continue
        if state[2] is None:
            state[2] = np.sort(np.concatenate(state[1])) if state[1] else np.zeros(0, np.uint64)
        yield i, at[0], state[2]


def _often(pages_of: DataFrame, big: DataFrame, parts: int) -> DataFrame:
    """(_host, _names): the names that MIN_PAGES different pages of a host have, of pages (_host, _sign, _names), in pieces.

    A host's names are dealt into groups, as many as `big` (_host, _groups) says.
    """
    pair = np.dtype([("name", "<u8"), ("sign", "<u4")])
    schema = [("_host", pa.string()), ("_group", pa.int64()), ("_pairs", pa.binary())]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[int, list[np.ndarray]]] = {}
        size = 0

        def rows() -> pa.RecordBatch:
            out = []
            for host, (n, every) in held.items():
                pairs = np.unique(np.concatenate(every))
                home = (pairs["name"] % np.uint64(n)).astype(np.int64)
                out += [(host, int(g), pairs[home == g].tobytes()) for g in np.unique(home)]
            held.clear()
            return _batch(schema, out)

        for b in batches:
            for host, sign, names, groups in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                names = np.frombuffer(names, "<u8")
                pairs = np.empty(len(names), pair)
                pairs["name"], pairs["sign"] = names, sign & 0xFFFFFFFF
                held.setdefault(host, (groups or 1, []))[1].append(pairs)
                size += len(names)
                if size >= HELD_TOKENS:
                    yield rows()
                    size = 0
            give_back()
        yield rows()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def answer() -> pa.RecordBatch:
            every, count = np.unique(np.unique(np.concatenate(held))["name"], return_counts=True)
            found = every[count >= MIN_PAGES]
            return _batch([("_host", pa.string()), ("_names", pa.binary())], [(now[0], found.tobytes())] if len(found) else [])

        for b in batches:
            for host, group, pairs in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if (host, group) != now:
                    if held:
                        yield answer()
                    now, held = (host, group), []
                held.append(np.frombuffer(pairs, pair))
            give_back()
        if held:
            yield answer()

    dealt = pages_of.select("_host", "_sign", "_names").join(F.broadcast(big), "_host", "left").mapInArrow(deal, "_host string, _group bigint, _pairs binary")
    return dealt.repartition(parts, "_host", "_group").sortWithinPartitions("_host", "_group").mapInArrow(add, "_host string, _names binary")


def _articles(plain: DataFrame, kind: str) -> DataFrame:
    """(_host, _key, _url, text) of the pages that mark their article, by the marks, or have no blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, texts = [], []
            for i, page in enumerate(b.column(3)):
                bs = blocks(page.as_py() or "")
                keep = _by_mark(bs) if bs else []
                if keep is not None:
                    at.append(i)
                    texts.append("\n".join(x.text for x, k in zip(bs, keep, strict=True) if k))
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(at, pa.int64())).columns[:3], pa.array(texts, pa.string())], names=["_host", "_key", "_url", "text"])
            give_back()

    return plain.select("_host", "_key", "_url", "_html").mapInArrow(run, f"_host string, _key {kind}, _url string, text string")


def _decided(first: DataFrame, plain: DataFrame, kind: str, parts: int, group_runs: int) -> DataFrame:
    """(_key, _url, text) of the pages that mark their article, without the host's boilerplate inside it."""
    outside = first.where("_outside IS NOT NULL").select("_host", "_sign", F.col("_outside").alias("_names"))
    # Few hosts have more than one group: as many as group_runs goes into all their runs.
    big = outside.groupBy("_host").agg(F.ceil(F.sum(F.octet_length("_names")) / (8 * group_runs)).cast("int").alias("_groups")).where("_groups > 1")
    boilerplate = stored(_often(outside, big, parts), "html-outside")
    slices = first.groupBy("_host").agg(F.ceil(F.count("_outside") / ARTICLE_SLICE).cast("int").alias("_slices")).where("_slices > 1")
    articles = _articles(plain, kind)
    if boilerplate.isEmpty():
        return articles.drop("_host")
    numbered = articles.where("text <> ''").withColumn("_row", F.monotonically_increasing_id())

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []
        for b in batches:
            rows, column = [], b.column(b.schema.get_field_index("text"))
            for i, host, names in _after_names(b, state):
                body = column[i].as_py().split("\n")
                mine = long_runs(body)
                mine = mine[_among(mine, names)]
                if len(mine):
                    rows.append((host, signature(body), mine.astype("<u8").tobytes()))
            yield _batch([("_host", pa.string()), ("_sign", pa.int64()), ("_names", pa.binary())], rows)
            give_back()

    asked = numbered.select("_host", "_row", "text").join(boilerplate.select("_host").distinct(), "_host", "left_semi")
    found = _told_first(asked, boilerplate, slices, parts).mapInArrow(inside, "_host string, _sign bigint, _names binary")
    repeated = stored(_often(found, big, parts), "html-inside")
    if repeated.isEmpty():
        return articles.drop("_host")
    hosts = repeated.select("_host").distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []
        for b in batches:
            at, texts, column = [], [], b.column(b.schema.get_field_index("text"))
            for i, _, names in _after_names(b, state):
                at.append(i)
                texts.append(article_text(column[i].as_py(), names))
            taken = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(taken.column(taken.schema.get_field_index(n)) for n in ("_key", "_url")), pa.array(texts, pa.string())], names=["_key", "_url", "text"])
            give_back()

    changed = _told_first(numbered.join(hosts, "_host", "left_semi"), repeated, slices, parts).mapInArrow(cut, f"_key {kind}, _url string, text string")
    same = [articles.where("text = ''"), numbered.join(hosts, "_host", "left_anti")]
    return changed.unionByName(same[0].select("_key", "_url", "text")).unionByName(same[1].select("_key", "_url", "text"))


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", pages: int = PAGES, group_runs: int = GROUP_RUNS) -> DataFrame:
    """One row per row of df: key, url, text, n_chars.

    A null or empty page, and one without main text, gives an empty text. A null url is a host of its own.
    Repeated rows are pages of their own; an empty table gives no rows; other columns are not read.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col("_url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    plain = df.select(df[key].alias("_key"), df[url].alias("_url"), df[html].alias("_html")).withColumn("_host", host)
    kind = df.schema[key].dataType.simpleString()
    first = stored(_first_pass(plain, kind).withColumn("_row", F.monotonically_increasing_id()), "html-first")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    decided = _decided(first, plain, kind, parts, group_runs).select(F.col("_key").alias(key), F.col("_url").alias(url), "text", F.length("text").cast("bigint").alias("n_chars"))
    undecided = first.where("_blocks IS NOT NULL")
    if undecided.isEmpty():
        return decided
    # One page stands for all of a host with the same longest block.
    chosen = undecided.groupBy("_host", "_sign").agg(F.min("_row").alias("_row"))
    standing = undecided.join(chosen.select("_row"), "_row", "left_semi").select("_host", "_blocks")
    hosts = first.groupBy("_host").agg(F.count("_blocks").alias("open"), F.count("_outside").alias("marked")).where("open > 0")
    marked = _marked_blocks(plain.join(hosts.where("marked > 0").select("_host"), "_host", "left_semi")).dropDuplicates(["_host", "_sign"]).join(chosen.select("_host", "_sign"), ["_host", "_sign"], "left_anti")
    runs = stored(_runs(standing.unionByName(marked.select("_host", "_blocks")), pages), "html-runs")
    answers = stored(_repeated(runs, parts, group_runs), "html-repeated")
    # A host's pages are dealt into slices, and each slice gets the host's repeated runs: a slice has a part of a large host's pages.
    slices = undecided.groupBy("_host").agg(F.ceil(F.count("*") / SLICE_PAGES).cast("int").alias("_slices"))
    asked = undecided.join(slices, "_host").select("_host", F.pmod(F.xxhash64("_row"), F.col("_slices")).cast("int").alias("_slice"), "_key", "_url", "_blocks", "_noise")
    told = answers.join(slices, "_host").select("_host", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"), "_names")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, ordered = None, [], None
        for b in batches:
            keys, urls, texts = [], [], []
            for i, at in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                if at != now:
                    now, names, ordered = at, [], None
                if b.column(6)[i].is_valid:
                    names.append(np.frombuffer(b.column(6)[i].as_py(), "<u8"))
                    continue
                if ordered is None:
                    ordered = np.sort(np.concatenate(names)) if names else np.zeros(0, np.uint64)
                keys.append(b.column(2)[i].as_py())
                urls.append(b.column(3)[i].as_py())
                texts.append(open_text(b.column(4)[i].as_py(), b.column(5)[i].as_py(), ordered))
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(2).type), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[key, url, "text", "n_chars"])
            give_back()

    both = asked.unionByName(told, allowMissingColumns=True)
    probed = both.repartition(parts, "_host", "_slice").sortWithinPartitions("_host", "_slice", F.col("_names").isNull())  # a host's runs before its pages
    return decided.unionByName(probed.mapInArrow(run, f"`{key}` {kind}, `{url}` string, text string, n_chars bigint"))
