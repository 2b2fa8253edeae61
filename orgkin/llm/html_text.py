"""Main text of web pages.

A page is read into blocks. What the markup marks as menu, header, footer, sidebar, notice,
advert, form, comment or code is chrome. All other blocks of a page, content or not, are its
stream, and suffix arrays over the streams of each host find the substrings of LEAST tokens
and more that several pages share. These decide on every page what goes:

* Pages with the same stream are copies and count as one.
* A page counts as evidence only if it has text of its own beside what it shares: whole
  blocks of LEAST tokens or a tenth of it. Copies with small edits vouch for nothing.
* What recurs on MOST of such pages of the host (three at least) is boilerplate wherever it
  stands. What recurs on fewer is boilerplate only on a page without marked content, and only
  if it reaches an edge of its block: a quotation inside a paragraph stays.
* No cut takes all the text of a page, or more than half of its marked content.

A page is marked if article or main elements hold more than half of its stream; then the
blocks outside them are left out.

The pages of a large host are dealt over several arrays, whose counts meet by the
fingerprints of the windows, so a host of any size is searched whole.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgkin.llm.common import documents, written

LEAST = 10  # tokens of a shared substring
MOST = 0.5  # of the pages of a host: a substring on so many is boilerplate everywhere
ARRAY_TOKENS = 500_000  # tokens of one suffix array

# --- Fixed values: element names and words in class, id and role by what they mean ------
CODE = "script style noscript template svg math iframe object canvas textarea title head".split()
CHROME = "nav footer aside form button select dialog menu header".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCKS = (
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul"
).split()
CHROME_WORDS = (
    "ad ads adbox advert adverts advertisement sponsor sponsored banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs comment comments disqus reply replies share sharing social related "
    "recommended promo promotion footer header masthead login signup widget toolbar pagination pager "
    "skip contentinfo complementary search hidden copyright"
).split()

_BLOCKS, _VOID, _CHROME, _WORDS = set(BLOCKS), set(VOID), set(CHROME), set(CHROME_WORDS)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    rf"|<(?P<raw>{'|'.join(CODE)})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
MARKS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?false)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
HEADINGS = {f"h{i}" for i in range(1, 7)}


def _is_chrome(name: str, attrs: str, inside: bool) -> bool:
    """``inside``: within the content. The header of an article is kept for its headings."""
    if name in _CHROME and not (name == "header" and inside):
        return True
    if not attrs:
        return False
    if HIDDEN.search(attrs):
        return True
    if name in ("html", "body", "article", "main"):
        return False
    return any(
        not _WORDS.isdisjoint(re.split(r"[^a-z]+", m[2].lower())) for m in MARKS.finditer(attrs)
    )


def blocks(page: str) -> list[tuple[str, str]]:
    """``kind, text`` of each block in order; kind is content, chrome or other.

    Open elements are closed as browsers do: a paragraph ends at the next block, a list item
    at the next one, and an end tag closes what is open inside.
    """
    out: list[tuple[str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, chrome, content

    def state():
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    def flush():
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            chrome, content = state()
            out.append(("chrome" if chrome else "content" if content else "other", text))

    for m in TOKEN.finditer(page):
        if m["text"] is not None:
            held.append(m["text"])
            continue
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in _VOID:
            if name == "hr":
                flush()
            elif name == "br":
                held.append(" ")
            continue
        if m["end"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name in _BLOCKS:
                flush()
            if depth is not None:
                if any(stack[i][0] in _BLOCKS for i in range(depth, len(stack))):
                    flush()
                del stack[depth:]
            continue
        if name in _BLOCKS:
            flush()
            if stack and any(s[0] == "p" for s in stack):
                at = max(i for i, s in enumerate(stack) if s[0] == "p")
                if not any(s[0] in _BLOCKS and s[0] != "p" for s in stack[at + 1:]):
                    del stack[at:]
            if name in ("li", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == name:
                stack.pop()
        chrome, content = state()
        attrs = m["attrs"] or ""
        here = content or name in ("article", "main") or bool(re.search(r"role\s*=\s*[\"']?main\b", attrs, re.I))
        stack.append((name, chrome or _is_chrome(name, attrs, content), here))
        if attrs.rstrip().endswith("/") and name not in _BLOCKS:
            stack.pop()
    flush()
    return out


def shared_windows(tokens: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array, the window (of LEAST tokens) that each suffix begins with, and the
    number of distinct pages of each window. ``page``: the page of each token.

    Suffixes are ranked by their first 1, 2, 4, ... tokens up to LEAST: a suffix array as
    deep as it matters. Suffixes of one rank share that many tokens, and one beyond the end
    of its page is not ranked with others.
    """
    n = len(tokens)
    if n < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while width < LEAST:
        step = min(width, LEAST - width)
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:]
        rank = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        width += step
    at = np.flatnonzero(page[: n - LEAST + 1] == page[LEAST - 1:])
    array = at[np.lexsort((page[at], rank[at]))]  # equal ones by page
    r, p = rank[array], page[array]
    new = np.concatenate([[True], r[1:] != r[:-1]])[: len(r)]
    window = np.cumsum(new) - 1
    other = new | np.concatenate([[True], p[1:] != p[:-1]])[: len(p)]
    return array, window, np.bincount(window, other).astype(np.int64)


def _fingerprints(tokens: np.ndarray, array: np.ndarray, window: np.ndarray) -> np.ndarray:
    """One number for each window, the same in all arrays."""
    first = array[np.flatnonzero(np.diff(window, prepend=-1))]
    total = np.zeros(len(first), np.uint64)
    for j in range(LEAST):
        total = total * np.uint64(0x9E3779B97F4A7C15) + tokens[first + j]
    return total ^ (total >> np.uint64(32))


def _covered(n: int, starts: np.ndarray) -> np.ndarray:
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + LEAST, minlength=n + 1)[: n + 1]
    return np.cumsum(change[:n]) > 0


PARSED = "page_id long, url string, host string, copy long, marked boolean, kinds array<string>, texts array<string>"


def _parsed(batches):
    for batch in batches:
        copy, marked, kinds, texts = [], [], [], []
        for page in batch.column("html"):
            found = [(k, t) for k, t in blocks(page.as_py() or "") if k != "chrome"]
            size = {"content": 0, "other": 0}
            for k, t in found:
                size[k] += len(t.split())
            copy.append(xxhash.xxh3_64_intdigest(" ".join(t for _, t in found)) - (1 << 63))
            marked.append(size["content"] > size["other"])
            kinds.append([k for k, _ in found])
            texts.append([t for _, t in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(copy, pa.int64()),
             pa.array(marked, pa.bool_()), pa.array(kinds, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string()))],
            ["page_id", "url", "host", "copy", "marked", "kinds", "texts"],
        )


def _streams(batches):
    """The packed tokens of each page, and the number of tokens of each block. A task gives
    each page with copies once."""
    seen = set()
    for batch in batches:
        names = zip(batch.column("host").to_pylist(), batch.column("copy").to_pylist(), strict=True)
        batch = batch.take(pa.array([i for i, name in enumerate(names) if name not in seen and not seen.add(name)], pa.int64()))
        words = [[t.split() for t in texts] for texts in batch.column("texts").to_pylist()]
        streams = [zlib.compress(" ".join(w for block in page for w in block).encode(), 1) for page in words]
        sizes = [[len(block) for block in page] for page in words]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("copy"), pa.array(streams, pa.binary()), pa.array(sizes, pa.list_(pa.int32()))],
            ["host", "copy", "stream", "sizes"],
        )


COUNTS = "host string, part long, bucket long, pages long, windows binary, counts binary"
SHARED = "host string, part long, pages long, windows binary, counts binary"
_COUNTS = pa.schema([("host", pa.string()), ("part", pa.int64()), ("bucket", pa.int64()), ("pages", pa.int64()),
                     ("windows", pa.binary()), ("counts", pa.binary())])
_SHARED = _COUNTS.remove(2)
_LEVELS = pa.schema([("host", pa.string()), ("copy", pa.int64()), ("levels", pa.binary())])


def _distinct(group: pa.Table) -> pa.Table:
    """The pages of an array, those that several tasks have read once."""
    return group.take(pa.array(np.sort(np.unique(group.column("copy").to_numpy(), return_index=True)[1])))


def _tokens(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The hashed tokens of the pages of an array and the page of each."""
    streams = [zlib.decompress(s).decode().split() for s in group.column("stream").to_pylist()]
    flat = np.array([w for s in streams for w in s], dtype=object)
    return pd.util.hash_array(flat, categorize=False), np.repeat(np.arange(len(streams)), [len(s) for s in streams])


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1)


def _bucketed(group: pa.Table, prints: np.ndarray, counts: np.ndarray, pages: int) -> pa.Table:
    """The windows of an array with their pages, dealt over as many buckets as the host has arrays."""
    host, part, parts = (group.column(c)[0].as_py() for c in ("host", "part", "parts"))
    bucket = (prints % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((prints, bucket))
    ends = np.searchsorted(bucket[order], np.arange(parts + 1))
    picks = [order[a:b] for a, b in zip(ends, ends[1:])]
    return pa.table(
        [[host] * parts, [part] * parts, list(range(parts)), [pages] * parts,
         [_packed(np.diff(prints[i], prepend=np.uint64(0))) for i in picks], [_packed(counts[i]) for i in picks]],
        schema=_COUNTS,
    )


def _first_counts(group: pa.Table) -> pa.Table:
    group = _distinct(group)
    tokens, page = _tokens(group)
    array, window, counts = shared_windows(tokens, page)
    prints = _fingerprints(tokens, array, window)
    if group.column("parts")[0].as_py() == 1:  # no other array can share them
        prints, counts = prints[counts > 1], counts[counts > 1]
    return _bucketed(group, prints, counts, group.num_rows)


def _met(group: pa.Table) -> pa.Table:
    """What the arrays of a host count together; each gets back its windows of several pages."""
    windows = [np.cumsum(_unpacked(x), dtype=np.uint64) for x in group.column("windows").to_pylist()]
    counts = [_unpacked(x) for x in group.column("counts").to_pylist()]
    place = np.unique(np.concatenate(windows), return_inverse=True)[1]
    total = np.bincount(place, np.concatenate(counts)).astype(np.int64)[place]
    out_windows, out_counts, at = [], [], 0
    for w in windows:
        own = total[at: at + len(w)]
        at += len(w)
        out_windows.append(_packed(np.diff(w[own > 1], prepend=np.uint64(0))))
        out_counts.append(_packed(own[own > 1]))
    pages = sum(group.column("pages").to_pylist())
    return pa.table(
        [group.column("host"), group.column("part"), [pages] * len(windows), out_windows, out_counts], schema=_SHARED
    )


def _supported(tokens: np.ndarray, page: np.ndarray, shared: pa.Table):
    """The suffix array, the window of each suffix, the fingerprint of each window, and the
    pages of the whole host that have it."""
    array, window, _ = shared_windows(tokens, page)
    prints = _fingerprints(tokens, array, window)
    none = [np.zeros(0, np.uint64)]
    known = np.concatenate(none + [np.cumsum(_unpacked(x), dtype=np.uint64) for x in shared.column("windows").to_pylist()])
    counts = np.concatenate(none + [_unpacked(x) for x in shared.column("counts").to_pylist()])
    order = np.argsort(known)
    known, counts = known[order], counts[order]
    if not len(known):
        return array, window, prints, np.zeros(len(prints), np.int64)
    at = np.minimum(np.searchsorted(known, prints), len(known) - 1)
    return array, window, prints, np.where(known[at] == prints, counts[at], 0).astype(np.int64)


def _second_counts(group: pa.Table, shared: pa.Table) -> pa.Table:
    """The shared windows again, with only those of their pages that have text of their own."""
    if not group.num_rows:
        return _COUNTS.empty_table()
    group = _distinct(group)
    tokens, page = _tokens(group)
    array, window, prints, support = _supported(tokens, page, shared)
    free = ~_covered(len(tokens), array[support[window] > 1])
    sizes = group.column("sizes").to_pylist()
    of_page = np.repeat(np.arange(len(sizes)), [len(s) for s in sizes])
    size = np.array([n for s in sizes for n in s], np.int64)
    left = np.bincount(np.repeat(np.arange(len(size)), size), free, len(size))
    own = np.bincount(of_page, np.where(2 * left >= size, size, 0), len(sizes))
    whole = np.bincount(of_page, size, len(sizes))
    witness = (own > 0) & ((own >= LEAST) | (10 * own >= whole))
    p = page[array]
    first = np.concatenate([[True], (window[1:] != window[:-1]) | (p[1:] != p[:-1])])[: len(p)]
    counts = np.bincount(window, first & witness[p], len(prints))
    return _bucketed(group, prints[support > 1], counts[support > 1], int(witness.sum()))


def _levels(group: pa.Table, shared: pa.Table) -> pa.Table:
    """For each token of a page 0, 1 if several pages share it, 2 if most do. Pages that share
    nothing are left out."""
    if not group.num_rows:
        return _LEVELS.empty_table()
    group = _distinct(group)
    tokens, page = _tokens(group)
    array, window, _, support = _supported(tokens, page, shared)
    support = support[window]
    pages = max(shared.column("pages").to_pylist(), default=0)
    level = _covered(len(tokens), array[support > 1]).astype(np.uint8)
    level += _covered(len(tokens), array[support >= max(3, MOST * pages)])
    ends = np.searchsorted(page, np.arange(group.num_rows + 1))
    found = [level[a:b] for a, b in zip(ends, ends[1:])]
    some = np.array([x.any() for x in found], bool)
    return pa.table(
        [group.column("host"), group.column("copy"), [zlib.compress(x.tobytes(), 1) for x in found]], schema=_LEVELS
    ).filter(pa.array(some))


def _kept(words: list[str], level: np.ndarray, marked: bool) -> list[str]:
    """The words of a block less its boilerplate."""
    gone = level > 1
    if not marked and level.any():
        edges = np.flatnonzero(np.diff(level > 0, prepend=False, append=False))
        for a, b in zip(edges[::2], edges[1::2]):
            if a == 0 or b == len(words):
                gone[a:b] = True
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def _unique_runs(batches):
    """The blocks of each page less what is boilerplate there."""
    for batch in batches:
        out = []
        for marked, kinds, texts, levels in zip(
            *(batch.column(c).to_pylist() for c in ("marked", "kinds", "texts", "levels")), strict=True
        ):
            size = sum(len(t.split()) for t in texts)
            level = np.frombuffer(zlib.decompress(levels), np.uint8) if levels else np.zeros(size, np.uint8)
            at, all_of, kept = 0, [], []
            for kind, text in zip(kinds, texts, strict=True):
                words = text.split()
                if kind == "content" or not marked:
                    all_of.append(words)
                    kept.append(_kept(words, level[at: at + len(words)], marked))
                at += len(words)
            left, whole = sum(map(len, kept)), sum(map(len, all_of))
            if not left or marked and 2 * left < whole:
                kept = all_of
            out.append("\n\n".join(" ".join(words) for words in kept if words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"]
        )


def extracted(pages: DataFrame) -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars``.

    Null and empty pages have an empty text. Ids and urls may be null or repeat; pages of a
    host with the same stream are one page and share no boilerplate with themselves; pages
    with a null url are a host of their own. Other columns are ignored; an empty table gives
    no rows.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)).alias("host"),
        "html",
    )
    parsed = written(rows.mapInArrow(_parsed, PARSED), "html-parsed", "zstd")
    size = F.aggregate("texts", F.lit(0), lambda a, t: a + F.size(F.split(t, " ")))
    parts = parsed.filter(F.size("texts") > 0).groupBy("host").agg(F.ceil(F.sum(size) / ARRAY_TOKENS).alias("parts"))
    # a host of several arrays has more than ARRAY_TOKENS tokens, so there are few of them
    several = F.broadcast(parts.filter("parts > 1"))
    streams = (
        parsed.filter(F.size("texts") > 0).select("host", "copy", "texts")
        .mapInArrow(_streams, "host string, copy long, stream binary, sizes array<int>")
        .join(several, "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod("copy", "parts"))
    )
    arrays = streams.groupBy("host", "part")

    def met(counts):
        return counts.groupBy("host", "bucket").applyInArrow(_met, SHARED).groupBy("host", "part")

    shared = met(arrays.applyInArrow(_first_counts, COUNTS))
    shared = met(arrays.cogroup(shared).applyInArrow(_second_counts, COUNTS))
    levels = arrays.cogroup(shared).applyInArrow(_levels, "host string, copy long, levels binary")
    text = parsed.join(levels, ["host", "copy"], "left").select(
        "page_id", "url", "marked", "kinds", "texts", "levels"
    ).mapInArrow(_unique_runs, "page_id long, url string, text string")
    return text.withColumn("n_chars", F.length("text").cast("long"))


def query(spark, sf_dir):
    return extracted(documents(spark, sf_dir, "pages"))
