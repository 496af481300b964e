"""Main text of web pages, through wrappers inferred for each host.

A page is read as a tree of tags and text slots. Neighbouring equal groups are folded into a
repeated group, at every level. The pages of a host are aligned one after the other, child list
by child list: groups that only some have become optional, texts that differ become slots. The
outcome, a union-free expression of tags, texts, optional and repeated groups, is the host's
wrapper. Tasks align the pages they read first, so one partial wrapper for each task and host is
what meets; a host with a third of all pages costs no more than others.

A host's pages with and without text in an article or main element have a wrapper each, as they
come from different templates. The wrappers decide which slots are the main text: those inside
such an element; for pages without, those inside the group with most text that varies, or for
pages that lack it the next such group, or else all slots; never those inside menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles or comments, told by element and by
whole words of class and id, alone or with usual words before and after them. No class or id drops
html, body, main or article, nor what holds all of a page's main and article text. Nor are the slots main text that the wrapper
knows as the template's own: those that every page of the host has, with the same text on each, where at least
``ENOUGH`` pages with different main texts were aligned and most of their text varies. A page that has no other text keeps them.
Elements nested more than
``DEEPEST`` deep are not told apart, but for those that drop or hold the main text. A page is read by the first of its host's sets of slots in which it has
text. On a host with articles, text outside every element is no main text.

Nulls: a null or empty page has an empty text; pages without a host share one wrapper. Broken
markup is read like a browser would: unknown closings are ignored, open elements end with their
parents. A null id stays null; repeated rows are read each; an empty table gives no rows.
"""

import html
import json
import re
from difflib import SequenceMatcher
from functools import reduce
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import functions as F

from grabqc.llm.common import keep

# Elements and words that mark what is not main text, and elements by kind. Fixed values.
DROPPED = set("nav footer aside form button select option textarea input dialog menu head script style template noscript iframe svg canvas "
              "object embed audio video map math".split())
DROPPED_WORDS = set("ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu menubar breadcrumb breadcrumbs "
                    "sidebar side-bar aside footer header masthead cookie cookies consent notice notices alert popup modal newsletter subscribe "
                    "subscription signup login share sharing social related recommended comment comments reply replies respond disqus "
                    "pagination pager skip-link toolbar widget".split())
# What may stand before or after a dropped word in a class or id: site-header, ad-slot, cookie-bar.
AFFIXES = set("site page global top bottom left right primary secondary inner outer wrap wrapper container box bar block area section list item items "
              "link links button buttons icon icons slot unit panel group form mobile desktop".split())
KEPT = set("html body main article".split())  # no class or id makes these something else
RAW = "script|style|title|textarea|noscript|template|iframe|svg|xmp|noembed|noframes"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span strike "
             "strong sub sup time tt u var wbr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table article main section div body html nav aside".split())
MAIN = ("article", "main")
TOKENS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>|<[!?][^>]*>?|(?P<text>[^<]+|<)", re.S | re.I)
ENOUGH = 4  # pages with different main texts that tell a template's own text from an article's
PARTS = 64  # tasks that align the partial wrappers of one host
DEEPEST = 200  # open elements that a path names one by one
MARKS = re.compile(r"(?P<kind>class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def mark(name, rest):
    """An element as the wrapper knows it: its name and the words of its class, role and id that tell of a template.

    A word with a digit in it and a word of an id mostly tell one page or element from the next; they count only if they
    drop the element. Else each page would have paths of its own.
    """
    words = set()
    for m in MARKS.finditer(rest) if "=" in rest else ():
        kind, *texts = m.groups()
        for word in " ".join(filter(None, texts)).lower().split():
            if dropped_word(word) or kind.lower() != "id" and not any(map(str.isdigit, word)):
                words.add(word)
    return ".".join([name, *sorted(words)])


def dropped(element):
    """Whether an element is not main text by its name, or by a whole word of its class or id."""
    if element not in SEEN:
        if len(SEEN) >= 1 << 16:
            SEEN.clear()
        name, *words = element.split(".")
        SEEN[element] = name in DROPPED or name not in KEPT and any(map(dropped_word, words))
    return SEEN[element]


SEEN = {}  # answers of a task; a plain dict goes to the workers by value, where a cache would be looked up by name


def dropped_word(word):
    parts = set(re.split(r"[-_]+", word))
    return word in DROPPED_WORDS or not parts.isdisjoint(DROPPED_WORDS) and parts <= DROPPED_WORDS | AFFIXES


class Open:
    """The open elements of a page, by mark and name.

    A path names the ``DEEPEST`` outermost of them. Of those further in it names the first that is dropped, the first
    article or main element and the first header, as these decide what is main text; what is nested
    deeper than any real template then stays in the slot of the element around it.
    """

    def __init__(self):
        self.marks, self.names, self.inline, self.told, self.path = [], [], 0, [], ()

    def push(self, known):
        name = known.split(".")[0]
        self.marks.append(known)
        self.names.append(name)
        self.inline += name in INLINE
        if len(self.marks) > DEEPEST:
            kinds = [k for k, is_it in (("gone", dropped(known)), ("main", name in MAIN), ("header", name == "header")) if is_it]
            if any(k not in before for k in kinds for before in [{k for _, ks, _ in self.told for k in ks}]):
                self.told.append((len(self.marks), kinds, known))
        self._changed()

    def cut(self, size):
        """Close all but the ``size`` outermost."""
        if size < len(self.marks):
            self.inline -= sum(n in INLINE for n in self.names[size:])
            del self.marks[size:], self.names[size:]
            while self.told and self.told[-1][0] > size:
                self.told.pop()
            self._changed()

    def _changed(self):
        path = (*self.marks[:DEEPEST], *(known for _, _, known in self.told))
        self.path = path if path != self.path else self.path

    def last(self, name):
        """How many elements stand around the innermost of that name; None without one."""
        for at in range(len(self.names) - 1, -1, -1):
            if self.names[at] == name:
                return at
        return None


def walk(page):
    """(path, text or None) in page order: a text at its path, or None where a block begins or ends.

    A path is the tuple of the open elements that are not inline. An inline element that is dropped
    is part of it, as are those inside, and begins no block, nor does what it holds.
    """
    opened = Open()
    for m in TOKENS.finditer(page):
        text = m["text"]
        if text is not None:
            yield opened.path, text
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        single = name in VOID or m["rest"].rstrip().endswith("/")
        if name in INLINE:
            if name == "br":
                yield opened.path, " "
                continue
            if opened.inline and (m["close"] or name == "a"):  # a link ends the one before
                first = next(i for i, n in enumerate(opened.names) if n in INLINE)
                at = opened.last(name)
                if at is not None and at >= first:
                    opened.cut(at)
            if not m["close"] and not single:
                known = mark(name, m["rest"])
                if opened.inline or dropped(known):
                    opened.push(known)
            continue
        if not opened.inline:
            yield opened.path, None
        if m["close"]:
            at = opened.last(name)
            if at is not None:
                opened.cut(at)
            continue
        at = opened.last("p")  # a block ends an open paragraph
        if at is not None and SCOPES.isdisjoint(opened.names[at + 1:]):
            opened.cut(at)
        if name in CLOSED_BY:
            for at in range(len(opened.names) - 1, -1, -1):
                if opened.names[at] in CLOSED_BY[name]:
                    opened.cut(at)
                    break
                if opened.names[at] in SCOPES:
                    break
        if not opened.inline:
            yield opened.path, None  # what has ended by now
        if not single:
            opened.push(mark(name, m["rest"]))
    yield (), None


def tree(page):
    """A page as [element, optional, repeated, children, text, letters]; ``text`` is a digest of a slot's text."""
    root = ["", 0, 0, [], None, 0]
    spine, path = [root], ()
    for new, text in walk(page):
        same = 0
        while same < min(len(path), len(new)) and path[same] == new[same]:
            same += 1
        del spine[same + 1:]
        for element in new[same:]:
            node = [element, 0, 0, [], None, 0]
            spine[-1][3].append(node)
            spine.append(node)
        path = new
        if text is not None and (stripped := " ".join(text.split())):
            children = spine[-1][3]
            if children and children[-1][0] == "#":
                children[-1][4] = digest(children[-1][4] + stripped)
                children[-1][5] += len(stripped)
            else:
                children.append(["#", 0, 0, [], digest(stripped), len(stripped)])
    return fold(root)


def digest(text):
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=6).hexdigest()


def fold(node):
    node[3] = folded([fold(c) for c in node[3]])
    return node


def folded(children):
    """Equal neighbours, and equal neighbouring groups of up to four, as one repeated group."""
    out = []
    for child in children:
        if out and out[-1][0] == child[0]:
            out[-1] = merge(out[-1], child, repeated=1)
        else:
            out.append(child)
    for size in (2, 3, 4):
        at = 0
        while at + 2 * size <= len(out):
            if [c[0] for c in out[at:at + size]] == [c[0] for c in out[at + size:at + 2 * size]]:
                out[at:at + 2 * size] = [merge(a, b, repeated=1) for a, b in zip(out[at:at + size], out[at + size:at + 2 * size])]
            else:
                at += 1
    return out


def merge(a, b, repeated=0):
    """Two nodes of one element aligned; texts that differ leave a slot."""
    return [a[0], a[1] | b[1], a[2] | b[2] | repeated, aligned(a[3], b[3]), a[4] if a[4] == b[4] else None, a[5] + b[5]]


def aligned(a, b):
    """Two lists of children; what stands in one only is optional."""
    if [c[0] for c in a] == [c[0] for c in b]:
        return [merge(x, y) for x, y in zip(a, b)]
    out = []
    for kind, i, j, k, n in SequenceMatcher(None, [c[0] for c in a], [c[0] for c in b], autojunk=False).get_opcodes():
        if kind == "equal":
            out += [merge(x, y) for x, y in zip(a[i:j], b[k:n])]
        else:
            out += [[c[0], 1, *c[2:]] for c in (*a[i:j], *b[k:n])]
    return folded(out)


def expression(node):
    """The wrapper as a union-free regular expression of tags, slots, optional and repeated groups."""
    inner = "".join(map(expression, node[3]))
    body = ("#PCDATA" if node[4] is None else "#TEXT") if node[0] == "#" else f"<{node[0]}>{inner}</{node[0].split('.')[0]}>" if node[0] else inner
    return f"({body}){'+' if node[2] else ''}{'?' if node[1] else ''}" if node[1] or node[2] else body


def holds_main(node):
    return any(c[0].split(".")[0] in MAIN or holds_main(c) for c in node[3])


def text_slots(wrapper, held=False):
    """(path, text, letters, whether every page has it) of the slots that may be main text.

    With ``held``, no class or id drops an element that holds an article or main element.
    """
    slots = []

    def visit(node, path, gone, everywhere):
        for child in node[3]:
            if child[0] == "#":
                if not gone:
                    slots.append((path, child[4], child[5], everywhere and not child[1]))
            else:
                name = child[0].split(".")[0]
                away = gone or name in DROPPED or name == "header" and not in_main(path) or dropped(child[0]) and not (held and holds_main(child))
                visit(child, (*path, child[0]), away, everywhere and not child[1])

    visit(wrapper, (), False, True)
    return slots


def template_slots(slots):
    """Paths of slots that are the template's own: on every page, with one text."""
    return {p for p, _, _, _ in slots} - {p for p, text, _, everywhere in slots if text is None or not everywhere}


def in_main(path):
    return any(e.split(".")[0] in MAIN for e in path)


def kind(page):
    """0 for a page (its tree) with text in an article or main element, 1 if only a class or id of what holds it drops that, else 2."""
    return next((k for k in (0, 1) if any(in_main(p) for p, *_ in text_slots(page, k == 1))), 2)


def main_digest(page, of):
    """Digest of what may be main text of a page (its tree) of one kind."""
    return digest(json.dumps([(p, text) for p, text, *_ in text_slots(page, of == 1) if of == 2 or in_main(p)]))


def main_slots(wrapper, of, enough=False):
    """Disjoint sets of paths, the first for most pages: the main text's slots in the wrapper of the pages of one kind.

    With ``enough`` pages behind the wrapper, slots of the template's own come last.
    """
    slots = text_slots(wrapper, of == 1)
    if of < 2:
        slots = [s for s in slots if in_main(s[0])]
    own = template_slots(slots) if enough else set()
    fixed = sum(size for p, _, size, _ in slots if p in own)
    if 2 * fixed >= sum(size for _, _, size, _ in slots):  # copies of one page tell nothing of a template
        own = set()
    left = {p for p, *_ in slots} - own
    if of < 2:
        return [s for s in (left, own) if s]
    letters = {}
    for path, text, size, _ in slots:
        if text is None or len(slots) == 1:
            letters[path[:-1]] = letters.get(path[:-1], 0) + size
    sets = []
    for best in [*sorted(letters, key=lambda p: (letters[p], p), reverse=True), ()]:
        sets.append({p for p in left if p[:len(best)] == best})
        left -= sets[-1]
    return [s for s in (*sets, own) if s]


def host_slots(kinds, texts=None):
    """The sets of a host's wrappers, given by kind, with digests of up to ``ENOUGH`` different main texts behind each."""
    sets = [s for k in sorted(kinds) for s in main_slots(kinds[k], k, texts is not None and len(texts[k]) >= ENOUGH)]
    return [s - {()} for s in sets] if min(kinds) < 2 else sets


def main_text(page, sets):
    """Blocks of the page's texts at the paths of the first set in which it has text, one line each."""
    read = list(walk(page or ""))
    present = {path for path, text in read if text and not text.isspace()}
    slots = next((s for s in sets if not s.isdisjoint(present)), ())
    blocks, current = [], []
    for path, text in read:
        if text is None:
            if current:
                blocks.append("".join(current))
                current = []
        elif path in slots:
            current.append(text)
    return "\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)


def host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def wrappers(pages, url_col="url", html_col="html"):
    """host, expression and sets of slots of each host's wrapper, from all its pages."""
    rows = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    partial = pa.schema([("host", pa.string()), ("kind", pa.int64()), ("tree", pa.string()), ("texts", pa.list_(pa.string()))])

    def align(batches):
        known, texts = {}, {}
        for batch in batches:
            for own, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if page:
                    new = tree(page)
                    key = own, kind(new)
                    known[key] = merge(known[key], new) if key in known else new
                    if len(texts.setdefault(key, set())) < ENOUGH:
                        texts[key].add(main_digest(new, key[1]))
        if known:
            yield pa.RecordBatch.from_pylist([{"host": key[0], "kind": key[1], "tree": json.dumps(t), "texts": sorted(texts[key])}
                                              for key, t in known.items()], schema=partial)

    def together(table):
        kinds, texts = {}, {}
        for k, text, own in sorted(zip(*[table.column(c).to_pylist() for c in ("kind", "tree", "texts")])):
            kinds[k] = merge(kinds[k], json.loads(text)) if k in kinds else json.loads(text)
            texts.setdefault(k, set()).update(own)
        return kinds, texts

    def halfway(table):
        kinds, texts = together(table)
        own = table.column("host")[0].as_py()
        return pa.Table.from_pylist([{"host": own, "kind": k, "tree": json.dumps(t), "texts": sorted(texts[k])[:ENOUGH]} for k, t in kinds.items()], schema=partial)

    def finish(table):
        kinds, texts = together(table)
        return pa.table({"host": [table.column("host")[0].as_py()], "expression": [expression(reduce(merge, kinds.values()))],
                         "slots": [json.dumps([sorted(s) for s in host_slots(kinds, texts)])]})

    # the partial wrappers of a host that all tasks read meet in two steps
    columns = "host string, kind long, tree string, texts array<string>"
    return (rows.mapInArrow(align, columns).groupBy("host", F.pmod(F.spark_partition_id(), F.lit(PARTS))).applyInArrow(halfway, columns)
            .groupBy("host").applyInArrow(finish, "host string, expression string, slots string"))


def extract(pages, id_col="page_id", url_col="url", html_col="html"):
    """Per page: page_id, url, text."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host(F.col(url_col)).alias("host"))
    known = keep(wrappers(pages, url_col, html_col), "wrappers").select("host", "slots")
    names = ["page_id", "url", "text"]

    def run(batches):
        slots = {}
        for batch in batches:
            texts = []
            for page, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if own not in slots:
                    slots[own] = [{tuple(p) for p in s} for s in json.loads(own)] if own else []
                texts.append(main_text(page, slots[own]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=names)

    joined = rows.join(known, "host", "left").select("page_id", "url", "html", "slots")
    schema = joined.select("page_id", "url", F.lit("").alias("text")).schema
    return joined.mapInArrow(run, schema)


def digests(pages):
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
