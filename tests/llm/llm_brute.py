"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(x: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), x)


def measures(text):
    t = text or ""
    w = SPACED.findall(t)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_dup_lines": dup, "n_repeat_words": len(covered), "base_failed": n < 50 or 100 * len(covered) > 50 * n}


def contamination(docs, items):
    """doc texts, (id, text) items -> (n_words, n_hit, item ids, contaminated) per text."""
    windows = collections.defaultdict(set)
    lengths = set()
    for item, text in items:
        w = ALNUM.findall(lower(text or ""))
        m = min(13, len(w))
        for i in range(len(w) - m + 1) if m else ():
            windows[tuple(w[i:i + m])].add("" if item is None else str(item))
            lengths.add(m)
    out = []
    for text in docs:
        w = ALNUM.findall(lower(text or ""))
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                ids = windows.get(tuple(w[i:i + m]))
                if ids:
                    hit |= set(range(i, i + m))
                    found |= ids
        out.append((len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def remove_repeats(docs, length=50):
    """(id, text) rows -> (n_bytes, n_removed, n_spans, sha) per row; None ids come last and never count as earlier."""
    key = lambda i: math.inf if i is None else i
    first = {}
    for i, text in docs:
        b = (text or "").encode()
        for k in range(len(b) - length + 1):
            g = b[k:k + length]
            first[g] = min(first.get(g, math.inf), key(i))
    out = []
    for i, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < key(i):
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text, width=3):
    w = SPACED.findall(lower(text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    count = [0] * 64
    for x in sh:
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(sh))


def hamming_roots(prints, bits=2):
    """A number per row, equal for rows of one component."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def hamming_components(ids, prints, bits=2):
    """Component id (smallest id that is not None) of each row."""
    roots, least = hamming_roots(prints, bits), {}
    for r, x in zip(roots, ids):
        if x is not None:
            least[r] = min(least.get(r, x), x)
    return [least.get(r) for r in roots]


def fold(doc_id, parts):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts


def tokens(text):
    return [*SPACED.findall(lower(text or "")), None]


def mix_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """{source: size} -> {source: target}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, out, left = share * sum(sizes.values()), {}, set(order)
    while left:
        rest, weight = total - sum(out.values()), sum(w[s] for s in left)
        over = [s for s in left if rest * w[s] / weight > most * sizes[s]]
        for s in over or left:
            out[s] = most * sizes[s] if over else rest * w[s] / weight
        left -= set(over or left)
    return out


def damage(rows):
    """(conv_id, turn, role, text) rows after the planted faults of the repair operator."""
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def repair(rows):
    """(turn, role, text) rows of one conversation -> gaps, blank, duplicate, truncated, illegal, cost, audit, sha: shortest
    paths over (rows done, state) by (cost, audit)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip("\t\n\x0b\x0c\r ")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", [])}

    def insert(best):
        for _ in range(4):
            for q, (c, a, kept) in list(best.items()):
                for role in ("user", "assistant"):
                    to = after.get((q, role[0]))
                    if to:
                        way = (c + 3, a + "I", [*kept, f"{role}:"])
                        best[to] = min(way, best.get(to, way))
        return best

    best = insert(best)
    for (_, role, text), fault in zip(rows, faults):
        then = {}
        for q, (c, a, kept) in best.items():
            ways = [("D", 4, q, kept)]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault else 0
                if (q, role[:1]) in after:
                    ways.append(("K", extra, after[q, role[:1]], [*kept, f"{role}:{text}"]))
                ways += [("R", 3 + extra, after[q, x[0]], [*kept, f"{x}:{text}"]) for x in ("user", "assistant") if (q, x[0]) in after]
            for letter, cost, to, lines in ways:
                way = (c + cost, a + letter, lines)
                then[to] = min(way, then.get(to, way))
        best = insert(then)
    cost, audit, lines = min(best[q] for q in ("", "a") if q in best)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def byte_level():
    """Byte-level character -> byte."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    out, n = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            out[chr(n)], n = b, n + 1
    return out


def align(docs, path_a, path_b):
    """(id, text) rows -> a Counter of result rows of the alignment operator."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok_a, tok_b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    tok_a.encode_special_tokens = True
    alphabet, pairs, kept = byte_level(), collections.Counter(), []
    for i, text in docs:
        kept.append((i, [], [], [], []))
        if not text:
            continue
        whole = (" " + text).encode()
        a, b = tok_a.encode(" " + text, add_special_tokens=False).ids, tok_b.encode(text)
        bytes_a = [bytes(alphabet[c] for c in tok_a.id_to_token(x)) for x in a]
        bytes_b = [bytes([int(tok_b.id_to_piece(x)[3:5], 16)]) if tok_b.is_byte(x) else tok_b.id_to_piece(x).replace("▁", " ").encode()
                   for x in b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            continue
        ends, at = {}, 0
        for k, x in enumerate(bytes_a):
            at += len(x)
            ends[at] = k + 1
        groups, at, begin = [], 0, (0, 0)
        for k, x in enumerate(bytes_b):
            at += len(x)
            if at in ends:
                groups.append((a[begin[0]:ends[at]], b[begin[1]:k + 1]))
                begin = (ends[at], k + 1)
        links = [(x[-1], y[-1]) for x, y in groups]
        pairs.update(links)
        kept[-1] = (i, a, b, groups, links)
    best = collections.Counter()
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    out = collections.Counter()
    for i, a, b, groups, links in kept:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[i, len(a), len(b), len(groups), len(links), sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if a else ""] += 1
    return out
