"""Plain restatements of what the operators must return, for small tables."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, k):
    w = WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def component_of(ids, links):
    """id -> smallest id reachable."""
    at = {i: i for i in ids}

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        at[b] = a
    return {i: root(i) for i in ids}


def near_duplicates(rows, k, percent):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    links = []
    for x in range(len(sets)):
        for y in range(x + 1, len(sets)):
            a, b = sets[x][1], sets[y][1]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    links.append((sets[x][0], sets[y][0]))
    comp = component_of({i for i, _ in rows}, links)
    return sorted((i, len(s), comp[i], comp[i] == i) for i, s in sets)


def one_of_each(rows, k, percent):
    """Rows that stay where the first text of each group does; texts of equal words are one."""
    own = {}
    for i, t in rows:
        own.setdefault(tuple(WORD.findall(lower(t))), set()).add(i)
    own = {w: min(i for i in ids if i is not None) for w, ids in own.items() if w and ids != {None}}
    texts = sorted(own, key=lambda w: (own[w], w))
    comp = {w: c for w, _, c, _ in near_duplicates([(w, " ".join(w)) for w in texts], k, percent)}
    first = {}
    for w in texts:
        first.setdefault(comp[w], w)
    stays = {(own[w], w) for w in first.values()}
    word = lambda t: tuple(WORD.findall(lower(t)))
    return [(i, t) for i, t in rows if i is None or not word(t) or (i, word(t)) in stays]


def suffix_dedup(rows, length=50):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w not in first or i < first[w]:
                first[w] = i
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = b"\x01" * length
        spans = len(re.findall(b"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def tokens(rows, tokenizer):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal_data(text):
    """{kind: [(start, end)]} of the base kinds."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }


def added_spans(rows, rounds=3, min_confidence=0.6, min_seeds=3):
    """{row number: {(kind, start, end)}} that contexts add, by dictionaries over all texts."""
    import regex

    kinds = ("email", "ip", "card", "phone")
    edges, totals, near = [], {}, {}
    for r, (_, t) in enumerate(rows):
        text, base = t or "", personal_data(t)
        words = list(WORD.finditer(text))
        low = [m[0].lower() for m in words]
        for i in range(2, len(words)):
            pair = (low[i - 2], low[i - 1])
            totals[pair] = totals.get(pair, 0) + 1
            if re.search("[0-9@]", text):
                near[pair] = near.get(pair, 0) + 1
            a, b = words[i].span()
            core = regex.search(r"[\p{L}0-9+](?s:.*[\p{L}0-9])?", words[i][0])
            if re.search("[0-9@]", words[i][0]) and core and re.search(r"[^+]", core[0]):
                start = a + core.start()
                here = [k for k in kinds if any(a <= s < b for s, _ in base[k])]
                meets = any(s < b and e > a for k in kinds for s, e in base[k])
                edges.append((r, pair, core[0], here[0] if here else None, meets, start, start + len(core[0])))
    links = {}
    for _, pair, inst, kind, *_ in edges:
        n, k = links.get((pair, inst), (0, None))
        links[pair, inst] = (n + 1, max(filter(None, (k, kind)), default=None))
    by_pair = {}
    for (pair, inst), (n, k) in links.items():
        by_pair.setdefault(pair, []).append((inst, n, k))
    graph = {p: v for p, v in by_pair.items() if len(v) >= min_seeds and sum(n for _, n, _ in v) >= min_confidence * near.get(p, 0)}
    seeds = {}
    for v in graph.values():
        for inst, _, k in v:
            seeds[inst] = seeds.get(inst) or k is not None
    belief = {i: 1.0 if s else 0.0 for i, s in seeds.items()}
    for _ in range(rounds):
        conf = {p: round(sum(n * belief[i] for i, n, _ in v) / totals[p], 9) for p, v in graph.items()}
        sure = {p: sum(belief[i] >= 0.5 for i, _, _ in v) for p, v in graph.items()}
        doubt = {}
        for p, v in graph.items():
            for i, _, _ in v:
                doubt[i] = doubt.get(i, 1.0) * (1 - (min(conf[p], 0.999) if sure[p] >= min_seeds else 0.0))
        belief = {i: 1.0 if s else 1 - doubt[i] for i, s in seeds.items()}
    good = {}
    for p, v in graph.items():
        named = [k for _, _, k in v if k]
        if named and conf[p] >= min_confidence and sure[p] >= min_seeds:
            good[p] = min(set(named), key=lambda k: (-named.count(k), k))
    out = {r: set() for r in range(len(rows))}
    for r, pair, _, _, meets, a, b in edges:
        if pair in good and not meets:
            out[r].add((good[pair], a, b))
    return out
