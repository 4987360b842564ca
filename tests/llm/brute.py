"""Plain re-statements of the contracts, independent of the operators' code."""

import hashlib
import re
from collections import defaultdict
from html.parser import HTMLParser

import xxhash


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def simhash(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), seed=42)
        for j in range(64):
            ones[j] += h >> j & 1
    return sum(1 << j for j in range(64) if ones[j] * 2 > len(grams))


def components(fps):
    """Smallest index reachable over pairs of at most 3 differing bits."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


def contamination(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add("" if i is None else str(i))
    out = []
    for doc_id, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def phrases(training, word):
    """Greedy longest-match phrases by plain substring search."""
    n, at = 0, 0
    while at < len(word):
        size = 1
        while at + size < len(word) and word[at:at + size + 1] in training:
            size += 1
        n, at = n + 1, at + size
    return n


class ArticleText(HTMLParser):
    """Block lines inside <article>; a <p> start ends an open block, white space is folded."""

    BLOCKS = {"p", "h1", "h2", "h3", "article", "div", "ul", "ol", "li", "blockquote", "nav", "footer", "header", "aside", "form", "section"}
    SKIP = {"nav", "header", "footer", "aside", "form", "script", "style"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.held, self.article, self.skip = [], "", 0, 0

    def flush(self):
        line = " ".join(self.held.split())
        if line:
            self.lines.append(line)
        self.held = ""

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.flush()
        if tag == "br":
            self.held += " "
        self.article += tag == "article"
        self.skip += tag in self.SKIP

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.flush()
        self.article -= tag == "article"
        self.skip -= tag in self.SKIP

    def handle_data(self, data):
        if self.article and not self.skip:
            self.held += data


def article_text(page):
    p = ArticleText()
    p.feed(page or "")
    p.close()
    p.flush()
    return "\n".join(p.lines)
