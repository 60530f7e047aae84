"""HTML extraction by union-free wrappers.

Every page is read leniently into a token stream: its text slots in page order, each known by the path
of block elements around it (name plus class, id and role). Neighbours of one kind, and groups of
slots that follow each other again, fold into a repeated group. The streams of one host are aligned,
two at a time, into that host's *wrapper*: a slot that one side lacks becomes optional, text that
differs becomes a varying slot, text that never differs stays a constant. The expression never needs
alternatives, so it is union-free.

The wrapper decides. Constants that stand on pages of different content are template and go; varying
slots are content. The same path may be both, above and below another slot: what counts is the place
in the expression. Class names are only a prior, for parts that the page itself calls advert, menu
or comment, and an article or main element settles what is inside it.

Pages are read once. Equal streams are counted in Spark before any alignment, so a host with a third
of all pages hands over each distinct stream once; partial wrappers of a host are aligned again, in
salted groups, until one is left. Each distinct stream is then laid against its host's wrapper, and
the pages take the slots to keep by a join on host and stream.

All slots of a host are aligned, however many. What changes beyond ``ALIGNED`` slots is only what tasks are handed: paths that
one stream alone has are laid over no other, so a run of them is one token of the wrapper, and each stream is handed the slots
of the wrapper that have its paths, with their places, not the whole wrapper. The alignment is the same as with all at hand.
The last partial wrappers of a host meet in one task: its memory grows with the shared slots and the runs of a host.
"""

from __future__ import annotations

import html as htmllib
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.common import staged, table

SALTS = (4096, 64, 1)      # a host's streams, then their wrappers, are aligned in so many groups in turn
ALIGNED = 20_000           # slots of a wrapper that every stream of its host is handed whole; of larger ones, those of its paths
HANDED = 2_000_000         # likewise, slots that all streams of a host are handed so

_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
              "small span strike strong sub sup time tt u var wbr img br button "
              "math mi mo mn ms mtext mrow mfrac msup msub msubsup mover munder munderover msqrt mroot mstyle mspace".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript template iframe svg select object canvas audio video annotation".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_ASIDE_TAGS = set("nav header footer aside form head dialog menu fieldset".split())
_ASIDE_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
                   "cookie cookies disqus footer header login menu modal nav navbar navigation newsletter notice notices "
                   "popup promo promoted promotion recommended related replies reply respond search share sharing "
                   "sidebar signup social sponsor sponsored subscribe tags toolbar topbar widget alert gdpr paywall "
                   "complementary contentinfo dialog form pagination pager hidden".split())
_ASIDE_STEMS = ("advert", "breadcrumb", "comment", "cookie", "footer", "navbar", "newsletter", "sidebar", "sidenav")
# a class with one of these says how a page is laid out (has-sidebar, header-fixed, comments-open), not what the element is
_STATE_WORDS = set("has have with without no not show hide fixed open opened closed enabled disabled visible layout".split())
_MAIN_WORDS = {"main"}

#: elements that hold text themselves: of class names, only those of adverts say that it is none
_TEXT_TAGS = _HEADINGS | set("p blockquote pre td th dd dt li figcaption caption".split())
_AD_WORDS = set("ad ads advert adverts advertisement advertising promo promoted promotion sponsor sponsored".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)


# ---- pages ------------------------------------------------------------------------------------


@lru_cache(maxsize=50_000)
def _label(name: str, attrs: str) -> str:
    """Element name plus its classes, id and role, words of one joined by hyphens (``hidden`` if it is not shown).
    Attributes are known by their whole name; the values of others are not looked into."""
    if not attrs.strip():
        return name
    words = set()
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role"):
            words |= {"-".join(_WORD.findall(c)) for c in value.lower().split()}
        elif key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and _UNSEEN.search(value):
            words.add("hidden")
    words.discard("")
    return f"{name} {' '.join(sorted(words))}".replace(">", "") if words else name


def _side(token: str, name: str) -> int:
    """2 if a class, id or role names a part that is no main text, 1 if it may (a word of it does), else 0."""
    words = token.split("-")
    if name in _TEXT_TAGS:
        return 2 if _AD_WORDS.issuperset(words) else 0
    side = [w in _ASIDE_WORDS or w.startswith(_ASIDE_STEMS) for w in words]
    if not any(side):
        return 0
    if all(side):
        return 2
    return 0 if not _STATE_WORDS.isdisjoint(words) else 1


@lru_cache(maxsize=50_000)
def _traits(label: str) -> tuple[int, bool, bool]:
    """(largest side of the classes, whether they or the name say main text, whether hidden)."""
    name, *tokens = label.split(" ")
    shown = [] if name in ("html", "body") else [t for t in tokens if t != "hidden"]
    main = name in ("article", "main") or any(not _MAIN_WORDS.isdisjoint(t.split("-")) for t in tokens)
    return max((_side(t, name) for t in shown), default=0), main, "hidden" in tokens


class _Element:
    """An open element, with what its path says so far, so that a path is never walked again."""

    __slots__ = ("name", "path", "out", "in_header", "around", "marked", "within", "inside")

    def __init__(self, name: str, label: str, parent: _Element | None):
        side, main, hidden = _traits(label)
        self.name = name
        self.path = xxhash.xxh3_64_intdigest(label.encode("utf-8", "surrogatepass"), parent.path if parent else 0)
        self.out, self.in_header = (parent.out, parent.in_header) if parent else (False, False)
        self.around, self.marked, self.within, self.inside = (
            (parent.around, parent.marked, parent.within, parent.inside) if parent else (0, "", 0, False))
        if name == "header" and self.inside:
            self.in_header = True  # only headings of it are text
        elif name in _ASIDE_TAGS or hidden:
            self.out = True
        if self.marked:
            self.within = max(self.within, side if side == 2 else 0)
        else:
            self.around = max(self.around, side)
            if name in ("article", "main"):
                self.marked = name
        self.inside = self.inside or main

    def rank(self) -> int:
        """0 for text that may be main text, 1 if only on pages without any such, 2 if it is to be left out.

        The first article or main overrides classes on itself and around it that only have a word of a side
        part; a main also those that name one, while an article there ranks 1. Inside, only a class that
        names a side part leaves out. Headings in an article's own header stay.
        """
        if self.out or self.in_header and self.name not in _HEADINGS:
            return 2
        around = {"": self.around, "main": 0, "article": max(0, self.around - 1)}[self.marked]
        return max(around, self.within)


def read_blocks(page: str | None) -> list[tuple[int, int, bool, bool, str, int]]:
    """(path, rank, inside main text, heading, text, characters inside links) of every non-empty block in page order.

    Character references are decoded, white space inside a block is one space; scripts, styles, comments
    and other raw elements are skipped. Unclosed elements end where their parent does; a paragraph
    ends where a block begins. Work and memory are linear in the page however deep it is.
    """
    out: list[tuple[int, int, bool, bool, str, int]] = []
    if not page:
        return out
    stack: list[_Element] = []
    open_names: Counter = Counter()
    parts: list[str] = []
    linked, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            top = stack[-1] if stack else _Element("", "", None)
            out.append((top.path, top.rank(), top.inside, top.name in _HEADINGS, text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def close(name: str) -> None:
        while stack:
            top = stack.pop()
            open_names[top.name] -= 1
            if top.name == name:
                break

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            text = htmllib.unescape(page[at:m.start()])
            parts.append(text)
            linked += len(text) * in_link
        at = m.end()
        if m[2] is None:
            continue
        closing, name = m[1], m[2].lower()
        if name in _INLINE:
            if name == "a":
                in_link = not closing
            elif name == "br":
                parts.append(" ")
            continue
        if name in _RAW:
            if not closing and not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
                parts.append(" ")
            continue
        flush()
        in_link = False
        if closing:
            if open_names[name] > 0:
                close(name)
        elif name not in _VOID:
            if open_names["p"] > 0:  # a block ends an open paragraph
                close("p")
            last = stack[-1].name if stack else ""
            if name in ("li", "dt", "dd", "tr", "td", "th", "option") and (last == name or {last, name} in ({"dt", "dd"}, {"td", "th"})):
                close(last)
            if name in ("article", "main"):  # never part of an unclosed menu or header
                while stack and stack[-1].name in ("nav", "header", "ul", "li", "form"):
                    close(stack[-1].name)
            stack.append(_Element(name, _label(name, m[3]), stack[-1] if stack else None))
            open_names[name] += 1
    if at < len(page):
        parts.append(htmllib.unescape(page[at:]))
    flush()
    return out


def fold(paths: list) -> list[tuple[int, bool]]:
    """For every token of a stream its place in the folded stream, and whether that is in a repeated group.

    A group of tokens that follows the same group again is laid over it: ``a b c b c d`` is ``a (b c)+ d``.
    """
    kept: list = []                     # the folded stream
    repeated: list[bool] = []
    where: list[int] = []
    last: dict = {}                     # path → its last places in the folded stream
    i = 0
    while i < len(paths):
        path, again = paths[i], None
        for p in reversed(last.get(path, ())):
            # does the stream go on as it did from p to its end?
            size = len(kept) - p
            if i + size <= len(paths) and all(paths[i + k] == kept[p + k] for k in range(1, size)):
                again = p
                break
        if again is None:
            last.setdefault(path, []).append(len(kept))
            del last[path][:-4]
            where.append(len(kept))
            kept.append(path)
            repeated.append(False)
            i += 1
        else:
            for p in range(again, len(kept)):
                where.append(p)
                repeated[p] = True
            i += len(kept) - again
    return [(p, repeated[p]) for p in where]


# ---- wrappers ---------------------------------------------------------------------------------
# A wrapper is a list of slots [path, flags, smallest and largest text hash, smallest and largest content hash, characters,
# of those in links, rank, inside main text, heading]; flags "?" optional, "+" repeated.

PATH, FLAGS, LO, HI, CONTENT_LO, CONTENT_HI, CHARS, LINKED, RANK, INSIDE, HEADING = range(11)


def _places(paths: Iterable) -> dict:
    places: dict = {}
    for j, path in enumerate(paths):
        places.setdefault(path, []).append(j)
    return places


def matches(a: list, places: Mapping) -> list[tuple[int, int, int]]:
    """Blocks (i, j, size) in which ``a`` equals the sequence that has every path at its ``places`` (ascending).

    The longest block is taken, of equals the first in ``a``, then in the other; then what is before both its sides and
    after both, in the same way: the blocks of ``difflib.SequenceMatcher``. Pairs of equal paths are looked at
    once, not once per block, so the time is near linear in them.
    """
    runs: list[tuple[int, int, int]] = []           # (-size, i, j) of two paths or more
    going: dict[int, int] = {}                      # last place → size of the runs that end at the path before
    for i, path in enumerate(a):
        now = {j: going.pop(j - 1, 0) + 1 for j in places.get(path, ())}
        runs += [(-n, i - n, j - n + 1) for j, n in going.items() if n > 1]
        going = now
    runs += [(-n, len(a) - n, j - n + 1) for j, n in going.items() if n > 1]
    heapify(runs)
    taken: list[tuple[int, int, int]] = []
    while runs:
        size, i, j = heappop(runs)
        size = -size
        at = bisect_left(taken, (i,))
        i0, j0, n0 = taken[at - 1] if at else (0, 0, 0)
        i1, j1, n1 = taken[at] if at < len(taken) else (i + size, j + size, 0)
        start, end = max(0, i0 + n0 - i, j0 + n0 - j), min(size, i1 - i, j1 - j)
        if start == 0 and end == size:
            taken.insert(at, (i, j, size))
            continue
        # blocks taken since cut it: what is left on both sides of the next one is tried again
        if end - start > 1:
            heappush(runs, (start - end, i + start, j + start))
        after = max(i1 - i, j1 - j) + n1
        if size - after > 1:
            heappush(runs, (after - size, i + after, j + after))
    out = []
    i = j = 0
    for block in [*taken, (len(a), float("inf"), 0)]:  # between two blocks only single paths are left
        for k in range(i, block[0]):
            found = places.get(a[k], ())
            at = bisect_left(found, j)
            if at < len(found) and found[at] < block[1]:
                out.append((k, found[at], 1))
                j = found[at] + 1
        out.append(block)
        i, j = block[0] + block[2], block[1] + block[2]
    return out[:-1]


def align(a: list, b: list) -> list:
    """Union-free expression over both streams."""
    out: list = []
    i = j = 0
    for i1, j1, n in [*matches([s[PATH] for s in a], _places(s[PATH] for s in b)), (len(a), len(b), 0)]:
        # present on one side only
        out += [x if "?" in x[FLAGS] else [x[PATH], "".join(sorted({*x[FLAGS], "?"})), *x[LO:]] for x in [*a[i:i1], *b[j:j1]]]
        i, j = i1 + n, j1 + n
        out += [[x[PATH], "".join(sorted({*x[FLAGS], *y[FLAGS]})), min(x[LO], y[LO]), max(x[HI], y[HI]),
                 min(x[CONTENT_LO], y[CONTENT_LO]), max(x[CONTENT_HI], y[CONTENT_HI]), x[CHARS] + y[CHARS], x[LINKED] + y[LINKED],
                 *x[RANK:]] for x, y in zip(a[i1:i], b[j1:j])]
    return out


def is_template(slot: list) -> bool:
    """Text that never differs although the pages it stands on do; never headings, nor inside main text."""
    return slot[LO] == slot[HI] and slot[CONTENT_LO] != slot[CONTENT_HI] and not slot[INSIDE] and not slot[HEADING]


def _is_menu(slot: list) -> bool:
    return slot[LINKED] * 2 > slot[CHARS]


def _varies(slot: list) -> bool:
    return slot[RANK] == 0 and not slot[INSIDE] and not is_template(slot) and not _is_menu(slot)


def _laid_over(stream: list, places: Mapping, wrapper: list | dict) -> list:
    """The wrapper's slot for each slot of ``stream``, or the stream's own where it has none."""
    judged = list(stream)
    for i, j, n in matches([s[PATH] for s in stream], places):
        for k in range(n):
            judged[i + k] = wrapper[j + k]
    return judged


def kept_slots(stream: list, wrapper: list, varies: bool = False) -> list[bool]:
    """Which slots of a page's ``stream`` are its main text, by its host's ``wrapper``. Slots that were laid over it before
    have no path and are the wrapper's; ``varies`` says whether one of that wrapper is varying text.

    Main text inside an article or main; on pages without any the varying text outside that is not mostly
    links; on pages without either what a class only suggests to be a side part, by the same rule. A host on
    which nothing varies (one page, or copies of one) keeps its constants.
    """
    judged = _laid_over(stream, _places(s[PATH] for s in wrapper), wrapper)
    varies = varies or any(map(_varies, wrapper))
    inside = [s[RANK] == 0 and s[INSIDE] for s in judged]
    loose = [s[RANK] == 0 and not s[INSIDE] and not _is_menu(s) and not (varies and is_template(s)) for s in judged]
    last = [s[RANK] == 1 and not _is_menu(s) and not is_template(s) for s in judged]
    return next((keep for keep in (inside, loose) if any(keep)), last)


def _align_group(pdf: pd.DataFrame) -> pd.DataFrame:
    wrapper = None
    for s in sorted(pdf["wrapper"]):
        wrapper = json.loads(s) if wrapper is None else align(wrapper, json.loads(s))
    return pdf[["_host", "salt"]].head(1).assign(wrapper=json.dumps(wrapper))


# Of a host beyond ALIGNED or HANDED, a run of slots of one stream whose paths no other stream has is one token
# [path of the first, flags, stream, place in it, slots, whether one is varying text].
RUN = 6


def _shortened(slots: list, stream: int, lone: set) -> list:
    """``slots`` of a stream with the runs of ``lone`` paths as one token each. Like their slots they match nothing and part what
    does, so wrappers of them are the same; and they sort alike, as no other wrapper has their first path."""
    out: list = []
    for at, s in enumerate(slots):
        if s[PATH] not in lone:
            out.append(s)
        elif out and len(out[-1]) == RUN:
            out[-1][4:] = [out[-1][4] + 1, out[-1][5] or _varies(s)]
        else:
            out.append([s[PATH], "", stream, at, 1, _varies(s)])
    return out


def _shorten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        short = [_shortened(json.loads(w), n, set(() if lone is None else lone)) for w, n, lone in zip(pdf["wrapper"], pdf["_stream"], pdf["lone"])]
        yield pdf[["_host", "_stream"]].assign(wrapper=[json.dumps(w, separators=(",", ":")) for w in short])


TOKEN_SCHEMA = "_host string, place long, slot string, path long, _stream long, at long, n long, varies boolean"


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Wrappers as rows: a slot with its path, or a run (no slot) with its stream; each with its place in the whole wrapper."""
    columns = [c.split()[0] for c in TOKEN_SCHEMA.split(", ")]
    for pdf in batches:
        for host, wrapper in zip(pdf["_host"], pdf["wrapper"]):
            rows, place = [], 0
            for s in json.loads(wrapper):
                run = len(s) == RUN
                rows.append((host, place, *(("", 0, *s[2:]) if run else (json.dumps(s, separators=(",", ":")), s[PATH], 0, 0, 1, _varies(s)))))
                place += s[4] if run else 1
                if len(rows) == 50_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def _lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Streams laid over the wrapper's slots that have their paths: [place, slot] of shared ones, [place, at, n] of runs."""
    for pdf in batches:
        laid = []
        for stream, shared, runs in zip(pdf["stream"], pdf["shared"], pdf["runs"]):
            slots = json.loads(stream)
            wrapper = dict(json.loads(shared))
            wrapper.update((place + k, slots[at + k]) for place, at, n in json.loads(runs) for k in range(n))
            places: dict = {}
            for j in sorted(wrapper):
                places.setdefault(wrapper[j][PATH], []).append(j)
            laid.append(json.dumps([[None, *s[FLAGS:]] for s in _laid_over(slots, places, wrapper)]))
        yield pdf[["_host", "_stream"]].assign(stream=laid)


@lru_cache(maxsize=8)
def _parsed(wrapper: str) -> list:
    return json.loads(wrapper)


# ---- operator ---------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    after = F.substring(url, F.char_length(rest) + 4, F.char_length(url))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def _signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


_SLOT = "path: long, flags: string, text_hash: long, chars: long, linked: long, rank: int, inside: boolean, heading: boolean"
STREAM_SCHEMA = f"_stream long, _content long, _slots array<struct<{_SLOT}>>, _blocks array<struct<slot: int, text: string>>"


def page_stream(page: str | None) -> tuple[int, int, list[tuple], list[tuple[int, str]]]:
    """(stream, content, slots, blocks) of a page: a number for its folded stream, one for its text, the slots of the
    stream with their text's hash and size, and every block's slot and text. Parts to be left out are not in it."""
    blocks = [b for b in read_blocks(page) if b[1] < 2]
    places = fold([(b[0], b[1], b[2], b[3]) for b in blocks])
    digest = lambda text: _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))
    joined: dict[int, list] = {}
    for (place, repeated), (path, rank, inside, heading, text, linked) in zip(places, blocks):
        one = joined.setdefault(place, [_signed(path), "+" if repeated else "", [], 0, rank, inside, heading])
        one[2].append(text)
        one[3] += linked
    slots = [(path, flags, digest("\n".join(texts)), sum(map(len, texts)), linked, rank, inside, heading)
             for _, (path, flags, texts, linked, rank, inside, heading) in sorted(joined.items())]
    stream = digest(json.dumps([(s[0], s[1], *s[5:]) for s in slots]))
    return stream, digest("\n".join(b[4] for b in blocks)), slots, [(p[0], b[4]) for p, b in zip(places, blocks)]


_SLOT_COLUMNS = ["path", "flags", "lo", "hi", "content_lo", "content_hi", "chars", "linked", "rank", "inside", "heading"]


def _json_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _slots_json(slots: Column) -> Column:
    """Slots as the JSON list that ``align`` reads."""
    def one(s: Column) -> Column:
        path, flags, *rest = [s[c] for c in _SLOT_COLUMNS]
        return F.concat(F.lit("["), F.concat_ws(",", path.cast("string"), F.concat(F.lit('"'), flags, F.lit('"')), *[c.cast("string") for c in rest]), F.lit("]"))

    return _json_list(F.transform(slots, one))


def _laid_streams(each: DataFrame, tokens: DataFrame) -> DataFrame:
    """``each`` (_host, _stream, slots) laid over their hosts' ``tokens`` → _host, _stream, stream (JSON, without paths)."""
    item = lambda *parts: F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    by_path = tokens.where("slot <> ''").groupBy("_host", "path").agg(F.array_join(F.collect_list(item("place", "slot")), ",").alias("shared"))
    shared = each.select("_host", "_stream", F.explode(F.array_distinct("slots.path")).alias("path")).join(by_path, ["_host", "path"]).groupBy(
        "_host", "_stream").agg(_json_list(F.collect_list("shared")).alias("shared"))
    runs = tokens.where("slot = ''").groupBy("_host", "_stream").agg(_json_list(F.collect_list(item("place", "at", "n"))).alias("runs"))
    found = each.select("_host", "_stream", _slots_json(F.col("slots")).alias("stream")).join(shared, ["_host", "_stream"], "left").join(
        runs, ["_host", "_stream"], "left")
    return found.fillna("[]", ["shared", "runs"]).mapInPandas(_lay, "_host string, _stream long, stream string")


def infer_wrappers(streams: DataFrame, aligned: int = ALIGNED) -> DataFrame:
    """``streams`` (_host, _stream, _content, _slots) → _host, _stream, stream and wrapper (JSON) per distinct stream of a host,
    and varies. All slots are aligned. Streams of a host with more than ``aligned`` slots (or beyond ``HANDED``) come laid over its
    wrapper: slots without a path, an empty wrapper, and varies says whether a slot of it is varying text."""
    # one row per distinct stream and slot: partial minima and sums in every task, whatever the host's size
    cells = streams.select("_host", "_stream", "_content", F.posexplode("_slots").alias("at", "s")).groupBy("_host", "_stream", "at").agg(
        *[F.first(f"s.{c}").alias(c) for c in ("path", "flags", "rank", "inside", "heading")],
        F.min("s.text_hash").alias("lo"), F.max("s.text_hash").alias("hi"), F.min("_content").alias("content_lo"),
        F.max("_content").alias("content_hi"), F.sum("s.chars").alias("chars"), F.sum("s.linked").alias("linked"))
    each = staged(cells.select("_host", "_stream", F.struct("at", *_SLOT_COLUMNS).alias("s")).groupBy("_host", "_stream").agg(
        F.array_sort(F.collect_list("s")).alias("slots")), "page-streams")
    of_stream = each.select("_host", "_stream", F.explode("slots.path").alias("path")).groupBy("_host", "_stream", "path").agg(F.count("*").alias("n"))
    paths = staged(of_stream.groupBy("_host", "path").agg(
        F.count("*").alias("streams"), F.max("n").alias("n"), F.max("_stream").alias("_stream")), "slot-paths")
    sizes = paths.groupBy("_host").agg(F.sum("n").alias("slots")).join(each.groupBy("_host").agg(F.count("*").alias("streams")), "_host")
    crowded = staged(sizes.where((F.col("slots") > aligned) | (F.col("slots") * F.col("streams") > HANDED)).select("_host"), "crowded-hosts")
    any_crowded = not crowded.isEmpty()
    whole = each.join(crowded, "_host", "left_anti") if any_crowded else each
    wrappers = whole.select("_host", _slots_json(F.col("slots")).alias("wrapper"), F.col("_stream").alias("salt"))
    if any_crowded:
        large = each.join(crowded, "_host", "left_semi")
        lone = paths.join(crowded, "_host", "left_semi").where("streams = 1").groupBy("_host", "_stream").agg(F.collect_list("path").alias("lone"))
        short = large.select("_host", "_stream", _slots_json(F.col("slots")).alias("wrapper")).join(lone, ["_host", "_stream"], "left").mapInPandas(
            _shorten, "_host string, _stream long, wrapper string")
        wrappers = wrappers.unionByName(short.withColumnRenamed("_stream", "salt"))
    for salts in SALTS:
        wrappers = wrappers.withColumn("salt", F.pmod("salt", F.lit(salts).cast("long"))).groupBy("_host", "salt").applyInPandas(
            _align_group, "_host string, salt long, wrapper string")
    wrappers = staged(wrappers.select("_host", "wrapper"), "wrappers")
    out = whole.select("_host", "_stream", _slots_json(F.col("slots")).alias("stream")).join(wrappers, "_host").withColumn("varies", F.lit(False))
    if not any_crowded:
        return out
    tokens = staged(wrappers.join(crowded, "_host", "left_semi").mapInPandas(_tokens, TOKEN_SCHEMA), "wrapper-slots")
    varies = tokens.groupBy("_host").agg(F.max("varies").alias("varies"))
    laid = _laid_streams(large, tokens).withColumn("wrapper", F.lit("[]")).join(varies, "_host")
    return out.unionByName(laid)


def extract_text(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``pages`` (url, html and any other columns, of which ``keep`` stay) plus ``text`` and ``n_chars`` (replacing such columns).

    ``text`` is the page's main text, blocks joined by newlines; empty for a null or empty page and for
    one without any. ``n_chars`` counts its code points. Repeated pages keep one row each; a page
    whose url is null or has no host is aligned with the others of that kind.
    """
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    hosted = pages.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], host_of(F.col("url")).alias("_host"), F.col("html").alias("_html"))
    kept_schema = ", ".join(f"k{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [page_stream(p) for p in pdf["_html"]]
            yield pdf.drop(columns="_html").assign(
                _stream=[g[0] for g in got], _content=[g[1] for g in got],
                _slots=[[dict(zip(("path", "flags", "text_hash", "chars", "linked", "rank", "inside", "heading"), s)) for s in g[2]] for g in got],
                _blocks=[[{"slot": n, "text": t} for n, t in g[3]] for g in got])

    read_once = staged(hosted.mapInPandas(read, f"{kept_schema + ', ' if keep else ''}_host string, {STREAM_SCHEMA}"), "page-blocks")

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            masks = [kept_slots(json.loads(s), _parsed(w), v) for s, w, v in zip(pdf["stream"], pdf["wrapper"], pdf["varies"])]
            yield pd.DataFrame({"_host": pdf["_host"], "_stream": pdf["_stream"], "_keep": masks})

    masks = staged(infer_wrappers(read_once).mapInPandas(choose, "_host string, _stream long, _keep array<boolean>"), "kept-slots")
    kept = F.filter("_blocks", lambda b: F.get(F.col("_keep"), b["slot"]))
    text = F.coalesce(F.array_join(F.transform(kept, lambda b: b["text"]), "\n"), F.lit(""))
    out = read_once.join(masks, ["_host", "_stream"], "left").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], text.alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
