"""Plain versions of the operators' contracts, one row at a time."""

import heapq
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

FOLD = {k: k + 32 for k in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS_DIGITS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern):
    return pattern.findall((text or "").translate(FOLD))


def shingles(text, width):
    found = words(text, SPACED)
    if len(found) < width:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[k : k + width]) for k in range(len(found) - width + 1))


def near_duplicates(rows, width, percent):
    """By id: set size and smallest id reachable; looks at all pairs."""
    sets = {doc: shingles(text, width) for doc, text in rows}
    parent = {doc: doc for doc in sets}

    def find(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    names = sorted(sets)
    for at, a in enumerate(names):
        for b in names[:at]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {doc: (len(sets[doc]), find(doc)) for doc in names}


def contamination(rows, items, window):
    """By id: words, hit words, items."""
    windows = defaultdict(set)
    for item, text in items:
        found = words(text, LETTERS_DIGITS)
        for k in range(max(1, len(found) - window + 1) if found else 0):
            windows[tuple(found[k : k + window])].add(item)
    result = {}
    for doc, text in rows:
        found = words(text, LETTERS_DIGITS)
        hit, names = set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(found) - size + 1):
                held = windows.get(tuple(found[k : k + size]))
                if held:
                    names |= held
                    hit |= set(range(k, k + size))
        result[doc] = (len(found), len(hit), sorted(map(str, names)))
    return result


def hit_words(text, items, window):
    """For each word of a text whether it stands in a window of an item, or in a whole shorter item."""
    found = words(text, LETTERS_DIGITS)
    marks = [False] * len(found)
    for _, item in items:
        own = words(item, LETTERS_DIGITS)
        size = min(window, len(own))
        held = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
        for k in range(len(found) - size + 1 if size else 0):
            if tuple(found[k : k + size]) in held:
                marks[k : k + size] = [True] * size
    return marks


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(number))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def fixed_forms(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [
        ("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))
    ]
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    order = ["email", "ip", "card", "phone"]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda s: (s[1], order.index(s[0]))))


def repeats(rows, length):
    """Per row: id, bytes, removed bytes, runs of them, checksum of what stays; looks at every string of ``length`` bytes."""
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(raw[k : k + length] for raw in texts for k in range(len(raw) - length + 1))
    result = []
    for (doc, _), raw in zip(rows, texts, strict=True):
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        result.append((doc, len(raw), sum(gone), len(re.findall(b"\1+", gone)), sha256(kept).hexdigest()))
    return result


RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def slipped_words(rows, every):
    for doc, text in rows:
        for run in RUNS.findall(text or ""):
            run = run.translate(FOLD)
            mark = crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = mark % len(run)
            yield run[:at] + run[at + 1 :] if every and mark % every == 0 else run


def one_edit_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def variants(words, shortest, fewest, times):
    """``word, form, root, n, n_near, form_n``; looks at all pairs."""
    counts = {w: n for w, n in Counter(w for w in words if len(w) >= shortest).items() if n >= fewest}
    form, near = {}, {}
    for word, n in counts.items():
        others = [w for w in counts if one_edit_apart(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= times * n else None
        near[word] = len(others)

    def root(word):
        return root(form[word]) if form[word] else word

    return [(w, form[w], root(w), n, near[w], counts[form[w]] if form[w] else None) for w, n in counts.items()]


def damaged(rows):
    result = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        result += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return result


def cheapest_edits(rows, faults):
    """Least cost, first edits in ASCII order and lines of them, by search over whole strings of edits."""
    waiting, done = [(0, "", 0, "", ())], set()
    while True:
        cost, edits, k, initials, lines = heapq.heappop(waiting)
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, edits, lines
        if (k, initials[-1:]) in done:
            continue
        done.add((k, initials[-1:]))
        steps = [(5, "I", k, role[0], ((role, ""),)) for role in ("user", "assistant")]
        if k < len(rows):
            role, text = rows[k]
            steps.append((2, "D", k + 1, "", ()))
            if faults[k] not in ("blank", "duplicate"):
                more = 5 * (faults[k] == "truncated")
                if role:
                    steps.append((more, "K", k + 1, role[0], ((role, text),)))
                steps += [(1 + more, "R", k + 1, to[0], ((to, text),)) for to in ("user", "assistant")]
        for price, edit, at, initial, line in steps:
            if re.fullmatch("s?(ua)*u?", initials + initial):
                heapq.heappush(waiting, (cost + price, edits + edit, at, initials + initial, lines + line))


def repair(rows):
    """Per conversation of ``rows`` (before damage) the results of the contract."""
    whole = damaged(rows)
    result = []
    for conv in {row[0] for row in rows}:
        own = sorted((r for r in whole if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in own:
            last = re.sub("[\x20\x09-\x0d]", "", text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum((a[2][:1], b[2][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(own, own[1:], strict=False))
        cost, audit, lines = cheapest_edits([r[2:] for r in own], faults)
        kept = "\n".join(f"{role}:{text}" for role, text in lines)
        counts = [faults.count(name) for name in ("blank", "duplicate", "truncated")]
        result.append((conv, gaps, *counts, illegal, cost, audit, sha256(kept.encode()).hexdigest()))
    return result
