"""Plain Python versions of the operators, one document at a time, written from the contracts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
UP = {c: c + 32 for c in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_words(text):
    return PLAIN.findall((text or "").translate(UP))


def license_base(text):
    """n_words, n_base, first_word, last_word, base labels."""
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    w = plain_words(text)
    at, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def license_spans(text, rules):
    """All matches of all rules as (start, end, rule), in words, before suppression."""
    w = plain_words(text)
    joined = " " + "  ".join(w) + " "
    out = set()
    for i, r in enumerate(rules):
        for m in re.finditer(r.pattern, joined):
            out.add((joined[: m.start()].count(" ") // 2, joined[: m.end()].count(" ") // 2, i))
    return out


def license_found(text, rules):
    spans = license_spans(text, rules)
    rank = lambda s: (rules[s[2]].priority, s[1] - s[0], -s[2])
    return sorted(s for s in spans if not any(o[0] <= s[0] and s[1] <= o[1] and rank(o) > rank(s) for o in spans))


def secret_spans(text, rules):
    out = []
    for kind, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", re.ASCII):
            if len(m.group(r.value)) >= r.least:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def items_windows(items, window=10):
    out = defaultdict(set)
    for item, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            out[tuple(w[i : i + window])].add(item)
    return out


def contamination(text, windows):
    """n_words, n_hit, items."""
    w = plain_words(text)
    hit, items = set(), set()
    for n in {len(k) for k in windows}:
        for i in range(len(w) - n + 1):
            got = windows.get(tuple(w[i : i + n]))
            if got is not None:
                hit.update(range(i, i + n))
                items |= got
    return len(w), len(hit), {str(x) for x in items if x is not None}


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def repeats(docs, length=50):
    """doc id to (n_bytes, n_removed, n_spans, sha of the rest); ids may repeat."""
    first = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s not in first or i < first[s]:
                first[s] = i
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, n=5):
    w = SPACED.findall((text or "").translate(UP))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(docs):
    """doc id to (set size, smallest id reachable by links)."""
    sets = {i: shingles(t) for i, t in docs}
    posts = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            posts[x].append(i)
    common = Counter()
    for ids in posts.values():
        for x in range(len(ids)):
            for y in range(x + 1, len(ids)):
                common[ids[x], ids[y]] += 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Source to target by handing the excess out again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        if not free:
            return full
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return full | share
        full |= {s: cap * sizes[s] for s in over}


def hashed(parts):
    return sha("".join(parts))


def levels(nodes):
    """All levels of a tree from its leaves to its root."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([hashed(out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def manifest(docs):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows (doc_id, text, lang, source, n_chars)."""
    leaf = lambda i, t, l, s, n: hashed("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, l, n, t))  # noqa: E731, E741
    trees = defaultdict(list)
    for d in docs:
        trees[d[2]].append(d)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    own = {}
    for x in order:
        trees[x].sort(key=lambda d: (d[0] is not None, d[0], leaf(*d)))
        own[x] = levels([leaf(*d) for d in trees[x]])
    top = levels([own[x][-1][0] for x in order])
    for t, x in enumerate(order):
        for i, d in enumerate(trees[x]):
            bad = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and d[1] is not None
            node, siblings = leaf(d[0], d[1].translate(UP) if bad else d[1], *d[2:]), []
            for every, at in ((own[x], i), (top, t)):
                for level in every[:-1]:
                    run, j = level[at // 8 * 8 : at // 8 * 8 + 8], at % 8
                    siblings += run[:j] + run[j + 1 :]
                    node, at = hashed([*run[:j], node, *run[j + 1 :]]), at // 8
            yield d[0], own[x][0][i], own[x][-1][0], top[-1][0], hashed(siblings), node, node == top[-1][0]


def collocations(docs, least=10, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows (doc_id, text, lang, ...)."""
    seen, n = Counter(), Counter()
    for d in docs:
        lang = "und" if d[2] is None else d[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (d[1] or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                seen.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    found = {p: a for p, a in seen.items() if len(p) > 2 and a >= least}
    per = defaultdict(list)
    for p, a in found.items():
        inside = (q for q in found if q[0] == p[0] and len(q) > len(p) and (q[1 : len(p)] == p[1:] or q[2:] == p[1:])) if len(p) == 3 else ()
        if any(100 * found[q] >= 50 * a for q in inside):
            continue
        cuts = [(1_000_000 * a * a // (seen[p[:k]] * seen[p[:1] + p[k:]]), k) for k in range(2, len(p))]
        score, k = min(cuts)
        per[p[0]].append((-score, -a, " ".join(p[1:]).encode(), seen[p[:k]], seen[p[:1] + p[k:]]))
    for lang, rows in per.items():
        for i, (s, a, phrase, left, right) in enumerate(sorted(rows)[:top]):
            yield lang, i + 1, phrase.decode(), -a, left, right, n[lang], -s


def token_ids(texts, end=1):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*x.ids, end] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def ids_crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def best_fit_decreasing(lengths, window):
    """Room left in each window, by trying all of them for every piece."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(window - n)
    return room
