"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of tags and texts. Repeats in a row (list items, paragraphs) are folded into one
repeated group. The streams of a host are aligned one after the other with the host's wrapper: equal
tokens match; texts that differ become text slots; tags found on one side only become optional. A wrapper
also adds up, per container, how much text outside links and boilerplate its slots held; from that it
names the main container of the host. A page is read by the wrapper of its host: the blocks inside the
main container, without boilerplate elements and without text that all pages of the host share.

Wrappers are small and merge in any order. Each task folds its pages into one wrapper per host, these are
merged per (host, salt) and then per host, so a host with a third of all pages is no hot group and no
task holds the pages of a host. The finished table (a few numbers per host) is broadcast up to MAX_HOSTS
hosts; beyond that pages and wrappers are joined by host.

Defined cases: null and empty html give an empty text; pages without a host share one wrapper; markup that
never closes is read to its end; repeated rows give repeated results; extra columns are ignored.
"""
from __future__ import annotations

import json
import re
from difflib import SequenceMatcher
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, shared

MAX_HOSTS = 100_000
SALTS = 32
MIN_PAGES = 10  # pages of differing text before a shared text counts as part of the template
MAIN_SHARE = 0.8
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p "
                  "pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("body article main section div td center".split())
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol table dl body article main section div".split())
# Elements, roles and class or id words that mark boilerplate.
DROP = frozenset("script style noscript template nav footer aside form button select option textarea iframe object svg canvas audio video dialog menu head title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
MARKS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu sidebar footer masthead breadcrumb breadcrumbs comment comments reply "
                  "replies disqus cookie cookies consent gdpr notice popup modal newsletter subscribe subscription signup login share sharing social related recommended recommendations toolbar "
                  "pagination pager skip copyright tracking respond".split())
WHOLE = frozenset("header alert side legal disclaimer widget top bottom".split())


def _attributes(raw: str) -> dict:
    return {m[0].lower(): (m[1] or m[2] or m[3]) for m in _ATTR.findall(raw)} if raw and raw.strip(" /") else {}


def _boilerplate(name: str, a: dict, inside_main: bool) -> bool:
    if name in DROP or (name == "header" and not inside_main):
        return True
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return True
    marks = f"{a.get('class', '')} {a.get('id', '')}".lower()
    return marks != " " and (not MARKS.isdisjoint(_WORDS.findall(marks)) or not WHOLE.isdisjoint(marks.split()))


def blocks(html: str):
    """Blocks of a page in order: (container path, tag, text, characters in links, boilerplate)."""
    stack: list[tuple] = []  # (tag, path, boilerplate, inside main)
    path, junk, main = "", False, False
    out, text, linked, depth = [], [], 0, 0
    kind = ""

    def flush():
        nonlocal linked
        t = " ".join(unescape("".join(text)).split()) if text else ""
        if t:
            out.append((path, kind, t, min(linked, len(t)), junk))
        text.clear()
        linked = 0

    def leave(upto: int):
        nonlocal path, junk, main, kind
        while len(stack) > upto:
            _, path, junk, main, kind = stack.pop()

    def find(names, stop=frozenset()) -> int:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                return k
            if stack[k][0] in stop:
                return -1
        return -1

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        piece = html[at:m.start()] if m else html[at:]
        if piece:
            text.append(piece)
            if depth:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        closing, name, raw = m.groups()
        if not name:
            continue
        name = name.lower()
        if name == "a":
            depth = 0 if closing else 1
        if closing:
            if name in BLOCK or name in DROP:
                k = find({name})
                if k >= 0:
                    flush()
                    leave(k)
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in CLOSES_P or name in SAME:
            flush()
            k = find({"p"}, SCOPE | {"td", "th"}) if name in CLOSES_P else -1
            if k >= 0:
                leave(k)
            k = find(SAME[name], SCOPE) if name in SAME else -1
            if k >= 0:
                leave(k)
        if name in BLOCK or name in DROP:
            flush()
            depth = 0 if name in BLOCK else depth
            if name in VOID:
                continue
            a = _attributes(raw)
            stack.append((name, path, junk, main, kind))
            junk = junk or _boilerplate(name, a, main)
            main = main or name in ("article", "main") or a.get("role") == "main"
            kind = name
            if name in CONTAINER:
                mark = _WORDS.findall((a.get("class") or a.get("id") or "").lower())
                path = f"{path}>{name}{'.' + mark[0] if mark else ''}"
        if name in RAW:
            stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            if name in DROP:
                leave(len(stack) - 1)
            else:
                text.append(html[at:stop.start() if stop else end])
            at = stop.end() if stop else end
    flush()
    return out


def stream(found) -> list[tuple]:
    """The page as folded tokens: (path, tag, text hash or '', repeated)."""
    out: list[tuple] = []
    for path, kind, text, _, junk in found:
        if junk:
            continue
        if out and out[-1][:2] == (path, kind):
            out[-1] = (path, kind, "", True)  # a repeat in a row is one group, its texts are slots
        else:
            out.append((path, kind, _hash(text), False))
    return out


def _hash(text: str) -> str:
    import hashlib

    return hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()[:16]


def new_wrapper(found) -> dict:
    """Wrapper of one page."""
    size: dict = {}
    for path, _, text, linked, junk in found:
        if not junk:
            size[path] = size.get(path, 0) + len(text) - linked
    page = _hash("\n".join(t for _, _, t, _, junk in found if not junk))
    return {"n": 1, "lo": page, "hi": page, "tokens": [[*t, False, 1] for t in stream(found)], "size": size}


def align(a: dict, b: dict) -> dict:
    """Merge two wrappers: matched tokens stay, differing texts become slots, the rest becomes optional."""
    x, y = a["tokens"], b["tokens"]
    out = []
    if [t[:2] for t in x] == [t[:2] for t in y]:
        steps = [("equal", 0, len(x), 0, len(y))]
    else:
        steps = SequenceMatcher(None, [tuple(t[:2]) for t in x], [tuple(t[:2]) for t in y], autojunk=False).get_opcodes()
    for op, i, j, k, m in steps:
        if op == "equal":
            out += [[p[0], p[1], p[2] if p[2] == q[2] else "", p[3] or q[3], p[4] or q[4], p[5] + q[5]] for p, q in zip(x[i:j], y[k:m], strict=True)]
        else:
            out += [[*t[:4], True, t[5]] for t in (*x[i:j], *y[k:m])]
    size = dict(a["size"])
    for p, n in b["size"].items():
        size[p] = size.get(p, 0) + n
    return {"n": a["n"] + b["n"], "lo": min(a["lo"], b["lo"]), "hi": max(a["hi"], b["hi"]), "tokens": out, "size": size}


def main_path(size: dict) -> str:
    """The container that holds the article: article or main elements if they hold text, else the deepest with most of it."""
    total = sum(size.values())
    if not total:
        return ""
    within: dict = {}
    for path, n in size.items():
        steps = path.split(">")
        for k in range(2, len(steps) + 1):
            p = ">".join(steps[:k])
            within[p] = within.get(p, 0) + n
    named = [p for p in within if p.rsplit(">", 1)[-1].split(".")[0] in ("article", "main") and within[p] >= 0.3 * total]
    if named:
        return max(named, key=lambda p: (p.rsplit(">", 1)[-1].startswith("article"), within[p], -len(p), p))
    good = [p for p in within if within[p] >= MAIN_SHARE * total]
    return max(good, key=lambda p: (p.count(">"), p), default="")


def finish(w: dict) -> dict:
    """What reading a page needs: the main container and the texts that belong to the template."""
    path = main_path(w["size"])
    fixed = [t[2] for t in w["tokens"] if t[2] and t[5] >= MIN_PAGES and 2 * t[5] > w["n"] and w["lo"] != w["hi"] and f"{t[0]}>".startswith(f"{path}>")]
    return {"path": path, "fixed": sorted(set(fixed))}


def read(found, rule: dict | None) -> str:
    """Main text of a page under the wrapper of its host."""
    live = [b for b in found if not b[4]]
    path = rule["path"] if rule else ""
    if not path or not any(f"{b[0]}>".startswith(f"{path}>") for b in live):
        size: dict = {}
        for p, _, t, linked, _ in live:
            size[p] = size.get(p, 0) + len(t) - linked
        path = main_path(size)
    fixed = set(rule["fixed"]) if rule else ()
    return "\n\n".join(t for p, _, t, _, _ in live if f"{p}>".startswith(f"{path}>") and not (fixed and _hash(t) in fixed))


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _pack(w: dict) -> str:
    return json.dumps(w, separators=(",", ":"))


def _infer(batches):
    got: dict = {}
    for b in batches:
        for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            w = new_wrapper(blocks(html or ""))
            got[host] = align(got[host], w) if host in got else w
        if len(got) > 2000:  # keep the task's table small; several rows of a host are fine
            yield pa.RecordBatch.from_arrays([pa.array(list(got)), pa.array([_pack(w) for w in got.values()])], ["host", "wrapper"])
            got = {}
    if got:
        yield pa.RecordBatch.from_arrays([pa.array(list(got)), pa.array([_pack(w) for w in got.values()])], ["host", "wrapper"])


def _merge(table: pa.Table) -> pa.Table:
    parts = sorted(table.column("wrapper").to_pylist())
    w = json.loads(parts[0])
    for p in parts[1:]:
        w = align(w, json.loads(p))
    return pa.table({"host": [table.column("host")[0].as_py()], "wrapper": [_pack(w)]})


def wrappers(pages: DataFrame) -> DataFrame:
    """One wrapper per host (columns host, wrapper as JSON)."""
    part = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_infer, "host string, wrapper string")
    salted = part.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    return salted.groupBy("host", "salt").applyInArrow(_merge, "host string, wrapper string").groupBy("host").applyInArrow(_merge, "host string, wrapper string")


def extract(pages: DataFrame, max_hosts: int = MAX_HOSTS) -> DataFrame:
    """Per page: page_id, url, text."""
    spark = pages.sparkSession
    shared(spark)
    rules = settle(wrappers(pages))
    kind = dict(pages.dtypes)["page_id"]
    schema = f"page_id {kind}, url string, text string"
    todo = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))

    def rows(b, rule_of):
        text = [read(blocks(h or ""), rule_of(k, i)) for i, (h, k) in enumerate(zip(b.column("html").to_pylist(), b.column("host").to_pylist(), strict=True))]
        return pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string())], ["page_id", "url", "text"])

    if rules.count() <= max_hosts:
        table = spark.sparkContext.broadcast({r["host"]: finish(json.loads(r["wrapper"])) for r in rules.collect()})

        def run(batches):
            for b in batches:
                yield rows(b, lambda host, _: table.value.get(host))

        return todo.mapInArrow(run, schema)

    def run_joined(batches):
        for b in batches:
            ws = b.column("wrapper").to_pylist()
            yield rows(b, lambda _, i, ws=ws: finish(json.loads(ws[i])))

    return todo.join(rules, "host").mapInArrow(run_joined, schema)
