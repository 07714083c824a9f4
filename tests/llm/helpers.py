"""Small tables and brute-force versions for the operators' tests."""

from collections import defaultdict


def brute_words(text, lower=False):
    out, word = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if lower and "A" <= c <= "Z" else c
    return [*out, word] if word else out


def brute_groups(rows, width, percent=80):
    """{doc_id: (set size, smallest doc_id reachable)} of (doc_id, text) rows."""
    sets = {}
    for i, text in rows:
        w = brute_words(text, lower=True)
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    near = defaultdict(set)
    for i, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                shared[j] += 1
        near[i] = {j for j, c in shared.items() if 100 * c >= percent * (len(s) + len(sets[j]) - c)}
    least = {}
    for i in sorted(sets):
        if i not in least:
            todo, least[i] = [i], i
            while todo:
                for j in near[todo.pop()]:
                    if j not in least:
                        least[j] = i
                        todo.append(j)
    return {i: (len(s), least[i]) for i, s in sets.items()}
