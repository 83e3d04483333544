"""Plain versions that the operators are compared with."""

import re


def plain_words(text, lower=False):
    data = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    return [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in data] if lower else data


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
