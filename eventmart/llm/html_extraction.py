"""Main text of web pages by template deduction over the pages of a host.

A page is a sequence of tokens: elements that open and close, known by their role (the path of tags, classes and ids),
and blocks of text. Over all pages of a host

1. each token's occurrence vector (how often it stands on each page) is summed up to a fingerprint of fixed size, and
   tokens of equal vectors are one equivalence class;
2. a class is valid if on every page its tokens come in one order, again and again, and if its rounds lie whole in one
   slot of the class around them; valid classes nest to the host's template;
3. what is left are the slots. Texts that the template itself holds count for nothing; the part of the template whose
   slots hold the text is the main one, and its slots are extracted from each page.

Fingerprints and orders are totalled by Spark for each (host, token) and (host, class), so a host of a third of all
pages is no larger group than any other; only tokens that stand on a fair share of a host's pages meet by host, and
these are few whatever its number of pages. Pages without a template, alone on their host or unlike its others,
are judged by their own structure.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import bounded_batches, discard, pieces, read_table, stored
from eventmart.llm.html_text import BY_NAME, BY_TAG, CONTAINERS, HEADER, HEADINGS, NONE, ROOT, TEXTS, Page, number, parse

#: Pages of a host below which no template is deduced, and the share of them that a token of a class stands on at least.
LEAST_PAGES, LEAST_SHARE = 2, 0.05
#: Pages of a host from which a text that stands on all of them, within the main part, is the template's and not the article's.
STATIC_PAGES = 8
#: Share of the text of a part that one within it must hold to be looked at in its place.
MAIN_SHARE = 0.6
#: Templates (one row for each host) that are broadcast to the pages; more of them are joined by host.
BROADCAST_HOSTS = 100_000
#: Tokens that a task totals before it sends them on.
HELD_TOKENS = 50_000
ELEMENT, TEXT = 0, 1
_SIXTY_FOUR = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mix(x: int) -> int:
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _SIXTY_FOUR
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _SIXTY_FOUR
    return x ^ (x >> 31)


def host_of(url: str) -> Column:
    """The host of a url, lower-cased, without user and port; '' where there is none."""
    return F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)


def page_table(pages: DataFrame, html: str, url: str) -> DataFrame:
    """host, page (a number of its own) and text."""
    return pages.select(host_of(url).alias("host"), F.monotonically_increasing_id().alias("page"), F.col(html).alias("text"))


def tokens_of(page: Page) -> dict[int, list]:
    """By token: its kind, the token around it, how often it occurs, characters, and of elements the tag and why it is no text."""
    out: dict[int, list] = {}
    for role, above, tag, why in page.elements:
        if (t := out.get(role)) is None:
            out[role] = [ELEMENT, page.elements[above][0] if above >= 0 else 0, 1, 0, tag, why]
        else:
            t[2] += 1
    for element, text, links in page.blocks:
        role = page.elements[element][0]
        own = len(text) - links
        out[role][3] += own
        token = number(role, text)
        if (t := out.get(token)) is None:
            out[token] = [TEXT, role, 1, own, "", NONE]
        else:
            t[2] += 1
            t[3] += own
    return out


def token_table(rows: DataFrame) -> DataFrame:
    """Per host and token: kind, above, tag, why, pages, chars, and its occurrence vector as two fingerprints (a, b)."""
    names = ["host", "token", "kind", "above", "tag", "why", "pages", "chars", "a", "b"]

    def send(held: dict) -> pa.RecordBatch:
        columns = list(zip(*[(host, token, *t) for (host, token), t in held.items()], strict=True))
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in pieces(batches):
            for host, n, text in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "text")), strict=True):
                for token, (kind, above, count, chars, tag, why) in tokens_of(parse(text)).items():
                    x = _mix(n * 0x9E3779B97F4A7C15 + count & _SIXTY_FOUR)
                    a, b = _signed(x), _signed(_mix(x ^ 0x243F6A8885A308D3))
                    if (t := held.get((host, token))) is None:
                        held[host, token] = [kind, above, tag, why, 1, chars, a, b]
                    else:
                        t[4] += 1
                        t[5] += chars
                        t[6] ^= a
                        t[7] ^= b
            if len(held) > HELD_TOKENS:
                yield send(held)
                held = {}
        if held:
            yield send(held)

    sent = rows.mapInArrow(scan, "host string, token long, kind int, above long, tag string, why int, pages long, chars long, a long, b long")
    first = [F.min(c).alias(c) for c in ("kind", "above", "tag", "why")]  # the same for all rows of a token
    return sent.groupBy("host", "token").agg(*first, F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))


def class_table(tokens: DataFrame) -> DataFrame:
    """Per host: n (its pages) and its tokens that stand on LEAST_SHARE of them, with their classes. At most some 1 / LEAST_SHARE
    times the tokens of one page meet here."""
    often = tokens.filter(F.col("pages") >= LEAST_PAGES)
    hosts = often.filter(F.col("token") == ROOT).select("host", F.col("pages").alias("n"))
    fair = often.join(hosts, "host").filter(F.col("pages") >= F.col("n") * LEAST_SHARE)
    return fair.groupBy("host").agg(F.first("n").alias("n"), F.collect_list(F.struct("token", "kind", "above", "tag", "why", "pages", "chars", "a", "b")).alias("tokens"))


def with_hosts(rows: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """rows with what is known of their host; table: stored, one row for each host."""
    few = table.select("host").limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    return rows.join(F.broadcast(table.select("host", *columns)) if few else table.select("host", *columns), "host", "left")


def orders(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Per host and class (its number): valid, if its tokens come in the same order on all pages and nest."""
    numbered = F.transform("tokens", lambda t: F.struct(t["token"].alias("token"), F.xxhash64(t["a"], t["b"]).alias("class")))
    given = stored(classes.select("host", F.col("tokens.token").alias("known"), F.transform(numbered, lambda t: t["class"]).alias("classes")), "classes", compression="zstd")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, dict[int, int]] = {}
        held: dict[tuple[str, int], list] = {}
        for batch in pieces(batches):
            hosts = batch.column("host").to_pylist()
            for k, (host, text) in enumerate(zip(hosts, batch.column("text").to_pylist(), strict=True)):
                if host not in of:
                    if len(of) > 1_000:
                        of.clear()
                    known, numbers = batch.column("known")[k].as_py(), batch.column("classes")[k].as_py()
                    of[host] = dict(zip(known or (), numbers or (), strict=True))
                for number_, order, slot, crossed in rounds_of(parse(text), of[host]) if of[host] else ():
                    if (t := held.get((host, number_))) is None:
                        held[host, number_] = [order, order, slot, slot, crossed]
                    else:
                        t[:] = min(t[0], order), max(t[1], order), min(t[2], slot), max(t[3], slot), t[4] + crossed
            if len(held) > HELD_TOKENS:
                yield send(held)
                held = {}
        if held:
            yield send(held)

    def send(held: dict) -> pa.RecordBatch:
        columns = list(zip(*[(*k, *t) for k, t in held.items()], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["host", "class", "o", "p", "s", "t", "crossed"])

    sent = with_hosts(rows, given, ["known", "classes"]).select("host", "text", "known", "classes").mapInArrow(scan, "host string, class long, o long, p long, s long, t long, crossed long")
    one = (F.min("o") == F.max("p")) & (F.min("s") == F.max("t")) & (F.sum("crossed") == 0)
    return sent.groupBy("host", "class").agg(one.alias("valid"))


def rounds_of(page: Page, classes: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """Of each class on a page: its number, the order of its tokens (as a number that no other order has; 0 if it changes from round
    to round), the slot around it (0 if it changes), and how often another class crosses it. Texts have their place in the order,
    but enclose nothing; one that an element of another class encloses alone (a paragraph, say) does not cross it."""
    marks: list[tuple[int, int]] = []  # class and token, in page order
    enclosing: list[int] = []  # classes of elements alone
    counts: dict[int, dict[int, int]] = defaultdict(dict)
    for e in page.events:
        if e >= 0:
            role = page.elements[e >> 1][0]
            own, token = classes.get(role), role ^ (e & 1)
            if own is not None:
                enclosing.append(own)
        else:
            element, text, _ = page.blocks[-1 - e]
            token = number(page.elements[element][0], text)
            own = classes.get(token)
        if own is not None:
            marks.append((own, token))
            counts[own][token] = counts[own].get(token, 0) + 1
    of: dict[int, list[int]] = defaultdict(list)
    for own, token in marks:
        of[own].append(token)
    period, order = defaultdict(int), {}
    for own, tokens in of.items():
        n = len(counts[own])
        same = len(set(counts[own].values())) == 1 and all(tokens[i] == tokens[i - n] for i in range(n, len(tokens)))
        order[own] = number(*tokens[:n]) if same else 0
    for role in {r for r, *_ in page.elements}:
        if role in classes:
            period[classes[role]] += 2  # opened and closed
    slot, crossed, stack = {}, defaultdict(int), []
    place: dict[int, int] = defaultdict(int)
    for own in enclosing:
        if not order[own]:
            continue
        if place[own] == 0:
            around = number(*stack[-1], place[stack[-1][0]]) if stack else 1
            slot[own] = around if slot.get(own, around) == around else 0
            stack.append((own,))
        elif stack[-1][0] != own:
            crossed[own] += 1
        place[own] += 1
        if place[own] == period[own]:
            place[own] = 0
            if stack[-1][0] == own:
                stack.pop()
            else:
                crossed[own] += 1
                stack[:] = [x for x in stack if x[0] != own]
    return [(own, order[own], slot.get(own, 2 if period[own] == 0 else 0), crossed[own]) for own in of]


def main_part(nodes: dict[int, tuple], overruled: set[int]) -> int:
    """The role of the part that holds the article. nodes: role -> (role above, tag, why, characters that no template holds)."""
    below: dict[int, list[int]] = defaultdict(list)
    for role, (above, *_) in nodes.items():
        below[above].append(role)
    order, todo = [], [ROOT]
    while todo:
        role = todo.pop()
        order.append(role)
        todo += [r for r in below[role] if nodes[r][2] not in (BY_NAME, BY_TAG) or r in overruled]
    mass: dict[int, int] = defaultdict(int)
    for role in reversed(order):
        mass[role] += nodes[role][3]
        mass[nodes[role][0]] += mass[role]
    now = ROOT
    while True:
        inner = [r for r in below[now] if r in mass]
        texts = nodes[now][3] or any(nodes[r][1] in TEXTS and mass[r] for r in inner)
        parts = [r for r in inner if nodes[r][1] in CONTAINERS]
        if nodes[now][1] in ("article", "main") and (texts or not any(nodes[r][1] == "article" for r in parts)) or not parts:
            return now
        best = max(parts, key=lambda r: (mass[r], r))
        articles = [r for r in parts if nodes[r][1] in ("article", "main") and mass[r]]
        if articles and mass[max(articles, key=lambda r: mass[r])] >= mass[now] / 2:
            best = max(articles, key=lambda r: (mass[r], r))
        elif texts and mass[best] < 0.9 * mass[now] or mass[best] < MAIN_SHARE * mass[now] or not mass[best]:
            return now
        elif texts and any(nodes[r][1] in HEADINGS and mass[r] for r in inner):
            return now  # the heading belongs to what stands beside it
        now = best


def overruled_parts(nodes: dict[int, tuple]) -> set[int]:
    """Parts called like a side part that hold an article, a first heading, or nearly all text."""
    total = sum(n[3] for n in nodes.values() if n[2] != BY_TAG)
    hold: dict[int, int] = defaultdict(int)
    holders: set[int] = set()
    for role, (_, tag, why, chars) in nodes.items():
        key = tag in ("article", "main", "h1")
        while role in nodes and (chars or key):
            if nodes[role][2] == BY_TAG:
                break
            hold[role] += chars
            if key:
                holders.add(role)
            role = nodes[role][0]
    return {r for r, n in nodes.items() if n[2] == BY_NAME and (r in holders or total and hold[r] >= 0.9 * total)}


def template_table(classes: DataFrame, validity: DataFrame) -> DataFrame:
    """Per host: main (the role of its main part), overruled and static (texts within it that are the template's)."""
    found = validity.filter(~F.col("valid")).groupBy("host").agg(F.collect_list("class").alias("invalid"))  # at most the classes of a host
    rows = classes.withColumn("classes", F.transform("tokens", lambda t: F.xxhash64(t["a"], t["b"]))).join(found, "host", "left")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(row["host"], *template_of(row["n"], row["tokens"], row["classes"], set(row["invalid"] or ()))) for row in batch.to_pylist()]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), longs, longs))], ["host", "main", "overruled", "static"])

    return rows.mapInArrow(build, "host string, main long, overruled array<long>, static array<long>")


def template_of(n: int, tokens: list[dict], numbers: list[int], invalid: set[int]) -> tuple[int | None, list[int], list[int]]:
    """A host's main part, overruled parts and static texts, from its tokens and the numbers of their classes."""
    valid = {t["token"]: t for t, c in zip(tokens, numbers, strict=True) if c not in invalid}
    root = valid.get(ROOT)
    if root is None:
        return None, [], []
    texts = [t for t in valid.values() if t["kind"] == TEXT and 2 * t["pages"] >= n]
    elements = {r: t for r, t in valid.items() if t["kind"] == ELEMENT}
    fixed: dict[int, int] = defaultdict(int)
    for t in texts:
        fixed[t["above"]] += t["chars"]
    free = {r: (t["above"], t["tag"], t["why"], max(0, t["chars"] - fixed[r])) for r, t in elements.items()}
    whole = {r: (t["above"], t["tag"], t["why"], t["chars"]) for r, t in elements.items()}
    overruled = overruled_parts(whole)
    side = {r for r, t in elements.items() if t["why"] in (BY_NAME, BY_TAG) and r not in overruled}
    varied = any(x[3] for r, x in free.items() if r not in side)
    static = [t["token"] for t in texts if varied and n >= STATIC_PAGES and (t["a"], t["b"]) == (root["a"], root["b"])]
    return main_part(free if varied else whole, overruled), sorted(overruled), static


def article(page: Page, main: int | None, overruled: set[int], static: set[int]) -> str:
    """The blocks of the main part, in page order. Without one, or where the page lacks it, the page is judged by its own structure."""
    elements = page.elements
    if main is None or all(role != main for role, *_ in elements):
        nodes: dict[int, list] = {}
        for role, above, tag, why in elements:
            nodes.setdefault(role, [elements[above][0] if above >= 0 else 0, tag, why, 0])
        for element, text, links in page.blocks:
            nodes[elements[element][0]][3] += len(text) - links
        overruled = overruled_parts(nodes)
        main = main_part(nodes, overruled)
        static = set()
    inside, out, header = [False] * len(elements), [False] * len(elements), [False] * len(elements)
    for i, (role, above, _, why) in enumerate(elements):
        inside[i] = role == main or above >= 0 and inside[above]
        out[i] = role != main and (above >= 0 and out[above] or why == BY_TAG or why == BY_NAME and role not in overruled)
        header[i] = role != main and (above >= 0 and header[above] or why == HEADER)
    kept = []
    for element, text, _ in page.blocks:
        if inside[element] and not out[element] and (not header[element] or elements[element][2] in HEADINGS):
            if not static or number(elements[element][0], text) not in static:
                kept.append(text)
    return "\n".join(kept)


def extracted(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The columns of pages, and `article`: the main text of each page, '' where there is none.

    Null html is an empty page; a null or odd url has the host ''. Pages of one host share a template from two pages
    on; repeated rows count each by itself. An empty table gives an empty result. Where pages has a column `article`,
    the added one has an underscore more.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = page_table(pages, html, url)
    tokens = stored(token_table(rows).filter(F.col("pages") >= LEAST_PAGES), "tokens", compression="zstd")
    classes = stored(class_table(tokens), "host-tokens", compression="zstd")
    templates = stored(template_table(classes, orders(rows, classes)), "templates", compression="zstd")
    discard(spark, tokens, classes)
    name = "article"
    while name in pages.columns:
        name += "_"
    whole = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host_of(url).alias("host"))
    both = with_hosts(whole, templates, ["main", "overruled", "static"])
    schema = both.select("row").schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, tuple] = {}
        for batch in batches:
            texts, out = batch.column("row").field(html), []
            for k, host in enumerate(batch.column("host").to_pylist()):
                if host not in of:
                    if len(of) > 1_000:
                        of.clear()
                    main, overruled, static = (batch.column(c)[k].as_py() for c in ("main", "overruled", "static"))
                    of[host] = main, set(overruled or ()), set(static or ())
                out.append(article(parse(texts[k].as_py() or ""), *of[host]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "article"])

    return both.mapInArrow(cut, schema.add("article", "string")).select("row.*", F.col("article").alias(name))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extracted(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("article").alias("text"), F.length("article").cast("long").alias("n_chars"))
