"""Plain versions of what the operators give, for small tables."""

import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words):
    found = WORD.findall((text or "").translate(UPPER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(len(found) - words + 1, 1)))


def components(texts: dict, words: int, percent: int = 80) -> dict:
    """doc_id to the smallest id reachable."""
    sets = {i: shingles(t, words) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    low, high = sorted((root(a), root(b)))
                    label[high] = low
    return {i: root(i) for i in ids}


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_matches(text):
    """(kind, match) of the base spans."""
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m[0])
            odd = [int(c) for c in number[::-1]]
            luhn = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(odd)) % 10 == 0
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(number) <= 19 and luhn):
                continue
            if kind == "phone" and not 8 <= len(number) <= 15:
                continue
            out.append((kind, m))
    return out


def base_spans(text) -> list[str]:
    return [f"{kind}:{m.start()}:{m.end()}" for kind, m in base_matches(text)]
