"""Plain-Python statements of what the corpus queries return, for tests on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def groups(ids, links):
    """The smallest id that each id reaches."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def similar_pairs(sets, num, den):
    """Every pair of different sets with den * intersection >= num * union, by prefixes of their rarest members."""
    seen = Counter(x for s in set(sets.values()) for x in s)
    holders, out = defaultdict(list), []
    kinds = defaultdict(list)
    for i, s in sorted(sets.items()):
        kinds[s].append(i)
    for own, ids in sorted(kinds.items(), key=lambda e: (len(e[0]), e[1])):
        out += [(ids[0], i) for i in ids[1:]] if own else []
        rare = sorted(own, key=lambda x: (seen[x], x))
        near = set()
        for x in rare[:len(rare) - math.ceil(num * len(rare) / den) + 1]:
            near.update(holders[x])
            holders[x].append(ids[0])
        for other in near:
            common = len(own & sets[other])
            if den * common >= num * (len(own) + len(sets[other]) - common):
                out.append((other, ids[0]))
    return out


def shingles(text, n=5):
    words = SPACED.findall((text or "").translate(LOWER))
    if 0 < len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def near_duplicates(docs):
    """{doc_id: (n_shingles, component_id, kept)}"""
    sets = {i: shingles(t) for i, t in docs.items()}
    found = groups(sets, similar_pairs(sets, 85, 100))
    return {i: (len(sets[i]), found[i], found[i] == i) for i in docs}


def line_sets(docs):
    """{(doc_id, line number): set of shingles of eight characters} of lines with a word."""
    out = {}
    for doc, text in docs.items():
        for number, line in enumerate((text or "").split("\n")):
            line = line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOWER)
            if line:
                out[doc, number] = (line, frozenset([line]) if len(line) < 8 else frozenset(line[i:i + 8] for i in range(len(line) - 7)))
    return out


def similar_lines(docs):
    """{doc_id: (n_lines, n_removed, removed)}"""
    lines = line_sets(docs)
    first = {}
    for place in sorted(lines):
        first.setdefault(lines[place][0], place)
    heads = {place: lines[place][1] for place in first.values()}
    found = groups(heads, similar_pairs(heads, 80, 100))
    out = {doc: [0, []] for doc in docs}
    for place, (line, _) in sorted(lines.items()):
        out[place[0]][0] += 1
        if found[first[line]] != place:
            out[place[0]][1].append(place[1])
    return {doc: (n, len(gone), ",".join(map(str, gone))) for doc, (n, gone) in out.items()}


def encoded(docs, path):
    """{doc_id: (start, n_tokens, ids_crc32)}"""
    import struct

    from tokenizers import Tokenizer
    tokenizer, out, start = Tokenizer.from_file(path), {}, 0
    for doc in sorted(docs):
        ids = [*tokenizer.encode(docs[doc] or "", add_special_tokens=False).ids, 2]
        out[doc] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return out


def contamination(docs, items):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = defaultdict(set)
    for item, text in items:
        words = PLAIN.findall((text or "").translate(LOWER))
        width = min(13, len(words))
        for i in range(len(words) - width + 1) if width else ():
            windows[tuple(words[i:i + width])].add(str(item))
    widths, out = sorted({len(w) for w in windows}), {}
    for doc, text in docs.items():
        words = PLAIN.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for width in widths:
            for i in range(len(words) - width + 1):
                own = windows.get(tuple(words[i:i + width]))
                if own:
                    found |= own
                    hit.update(range(i, i + width))
        out[doc] = (len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words))
    return out


def quality_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    words = SPACED.findall(text or "")
    lines = [line for line in (text or "").split("\n") if SPACED.search(line)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))


def repeated_words(docs):
    """{doc_id: (n_words, n_removed, kept_sha256)}"""
    seen, out = set(), {}
    for doc in sorted(docs):
        words = SPACED.findall(docs[doc] or "")
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        out[doc] = (len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
                    r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)"""
    text = text or ""
    found = [[(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8],
             [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16],
             [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]]
    names = ["assign", "access", "hex"]
    return (*map(len, found), sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(sum(found, [])))))


def conversations(turns):
    """{conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)} of (conv_id, turn, role, text)"""
    out = defaultdict(list)
    for conv, turn, role, text in turns:
        out[conv].append((turn, role or "", text or ""))
    return {conv: (len(rows), sha("".join(f"{r}\n{t}\n" for _, r, t in sorted(rows))),
                   sum(len(t) for _, r, t in rows if r == "assistant"),
                   sha("".join(t for _, r, t in sorted(rows) if r == "assistant"))) for conv, rows in out.items()}
