"""Edit distances by their definition."""


def osa(a: str, b: str) -> int:
    """Optimal string alignment distance: edits plus adjacent swaps at cost one."""
    before, row = [], list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, cb in enumerate(b, 1):
            best = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (ca != cb))
            if i > 1 and j > 1 and ca == b[j - 2] and a[i - 2] == cb:
                best = min(best, older[j - 2] + 1)
            row.append(best)
    return row[-1]
