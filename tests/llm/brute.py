"""Plain-Python versions of the operators' contracts, for small tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def covered(n, starts, width):
    at = set()
    for s in starts:
        at.update(range(s, min(n, s + width)))
    return at


def base_stats(text):
    """Contract of operator 2: (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    repeat = len(covered(len(words), [i for i, w in enumerate(windows) if many[w] > 1], 5))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat,
            len(words) < 10 or 100 * repeat > 20 * len(words))


def line_verdicts(rows, min_docs, max_percent, min_left_percent):
    """Of (doc_id, text, host) rows: (removed words, kept) by operator 2's method."""
    def norm(line):
        return " ".join(SPACED.findall(line.translate(LOWER)))
    docs, hosts = defaultdict(set), defaultdict(set)
    for doc_id, text, host in rows:
        hosts[host].add((doc_id, text))
        for line in (text or "").split("\n"):
            if norm(line):
                docs[host, norm(line)].add((doc_id, text))
    out = []
    for doc_id, text, host in rows:
        n, *_, failed = base_stats(text)
        gone = 0
        for line in (text or "").split("\n"):
            k = len(docs.get((host, norm(line)), ()))
            if k >= min_docs and 100 * k > max_percent * len(hosts[host]):
                gone += len(SPACED.findall(line))
        out.append((gone, not failed and n - gone >= 10 and 100 * (n - gone) >= min_left_percent * n))
    return out


def remove_repeats(rows, width=20):
    """Contract of operator 3 for distinct (doc_id, text) rows in order: (n_words, n_removed, sha256)."""
    seen, out = set(), []
    for _, text in rows:
        words = SPACED.findall(text or "")
        again = []
        for i in range(len(words) - width + 1):
            w = tuple(words[i:i + width])
            if w in seen:
                again.append(i)
            seen.add(w)
        gone = covered(len(words), again, width)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def fingerprint(text, size=3):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, max_bits=3):
    """Smallest index of each fingerprint's component, by all pairs."""
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= max_bits:
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def contamination(texts, items, width=13):
    """Contract of operator 8: (n_words, n_hit, items, contaminated) for each text; items: (id, text)."""
    windows = defaultdict(set)
    for item_id, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        n = min(width, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i:i + n])].add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def judge_url(url, listed):
    """Contract of operator 9: (host, path, rule, verdict)."""
    host = path = ""
    if url and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
        host, slash, tail = rest.partition("/")
        host, path = host.translate(LOWER), slash + tail
    fits = [r for r in RULES if ("." + host).endswith("." + r.split("/", 1)[0]) and path.startswith("/" + r.split("/", 1)[1])]
    if fits:
        rule = max(fits, key=len)
        return host, path, rule, RULES[rule]
    labels = host.split(".")
    bad = (any(".".join(labels[i:]) in listed for i in range(len(labels))) or path != "" and host + path in listed) if host else False
    return host, path, None, "block" if bad else "allow"


def crc(data):
    return zlib.crc32(data)


def near_vectors(rows, min_cos=0.9):
    """(vec_id, n_links, component_id, kept) of rows (vec_id, vector), by all pairs."""
    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if fine(v) else None for _, v in rows]
    part, links = list(range(len(rows))), [0] * len(rows)
    for i, a in enumerate(unit):
        for j, b in enumerate(unit):
            if i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= min_cos - 1e-12:
                links[i] += 1
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    first = {}
    for (i, _), p in zip(rows, part):
        first[p] = min((x for x in (i, first.get(p)) if x is not None), default=None)
    return [(i, n, first[p], i is not None and i == first[p]) for (i, _), n, p in zip(rows, links, part)]


def trie(rows):
    """The contract's nodes of rows (conv_id, turn, role, text), from a dictionary of prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [t for *_, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[x] for x in children[key]) or 1
        saved[key] = sum(saved[x] for x in children[key]) + ((len(members[key]) - 1) * len(key[-1][1]) if key else 0)
    return [(min(m), len(key), min(members[key[:-1]]) if key else None, len(m), len(children[key]), leaves[key], saved[key],
             hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(key)))).encode()).hexdigest())
            for key, m in members.items()]


def spelling(rows, min_length=5, min_count=3, ratio=2, typo=97):
    """(word, form, root, n, n_near, form_n) of rows (doc_id, text), near words by letters taken out."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % typo == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += 1
    n = {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}
    cut, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            cut[i, w[:i] + w[i + 1:]].add(w)
    for (_, rest), words in cut.items():
        for w in words:
            near[w] |= words - {w}
            if rest in n:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return [(w, form.get(w), root(w), k, len(near[w]), n[form[w]] if w in form else None) for w, k in n.items()]


def language_shares(text):
    """Shares of the pairs and triples that start at each byte of ``text``, by feature number."""
    def kind(b):
        if 0x41 <= b <= 0x5A:
            return b + 32
        if 0x30 <= b <= 0x39:
            return 0x30
        return b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    c = [kind(b) for b in text.encode()]
    shares = [0.0] * 4096
    for i, x in enumerate(c):
        y, z = (c + [0x20, 0x20])[i + 1:i + 3] if i + 2 >= len(c) else c[i + 1:i + 3]
        pair = x * 0x9E3779B1 + y * 0x85EBCA77
        shares[(pair & 0xFFFFFFFF) >> 21] += 1 / len(c)
        shares[2048 + (((pair + z * 0xC2B2AE3D) & 0xFFFFFFFF) >> 21)] += 1 / len(c)
    return shares


def languages(rows, families, solve):
    """Of rows (doc_id, text, lang): (lang_pred, score) of each, learnt from those outside the held-out third.

    ``solve(x, y)`` gives a machine's weights, bias and slope.
    """
    shares = [language_shares(text) if text else None for _, text, _ in rows]
    learnt = [(x, lang) for (doc_id, _, lang), x in zip(rows, shares)
              if x and lang is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 != 1]
    members = {}
    for lang in sorted({lang for _, lang in learnt}):
        members.setdefault(families.get(lang, lang), []).append(lang)

    def machine(left, right):
        mine = [(x, 1 if lang in left else -1) for x, lang in learnt if lang in left or lang in right]
        return solve([x for x, _ in mine], [y for _, y in mine])

    def tell(names, machines, x):
        """The name with most votes (ties: larger probability, then name), and its mean probability."""
        votes, proba = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        for (a, b), (w, bias, slope) in machines.items():
            if a in votes and b in votes:
                p = 1 / (1 + math.exp(-slope * (sum(u * v for u, v in zip(w, x) if v) + bias)))
                votes[a if p >= 0.5 else b] += 1
                proba[a] += p
                proba[b] += 1 - p
        best = max(names, key=lambda n: (votes[n], proba[n]))
        return best, proba[best] / (len(names) - 1) if len(names) > 1 else 1.0

    of_families = {(a, b): machine(members[a], members[b]) for a, b in itertools.combinations(sorted(members), 2)}
    of_langs = {(a, b): machine([a], [b]) for langs in members.values() for a, b in itertools.combinations(langs, 2)}
    out = []
    for (_, text, _), x in zip(rows, shares):
        if not text or not any(ch.isalpha() for ch in text):
            out.append(("und", 0.0))
            continue
        family, p = tell(sorted(members), of_families, x)
        lang, q = tell(members[family], of_langs, x)
        out.append((lang, p * q))
    return out
