"""Helpers of the library's tests."""


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def linked(n, pairs):
    """The least of what each of 0..n-1 hangs together with by the pairs."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def cluster_name(titles):
    """The first words in a row of the longest title that another title has, too."""
    from civicflow.udfs.fuzzy import partial_ratio

    longest = max(titles, key=lambda t: (len(t), t))
    marks = [sum(partial_ratio(w, t) >= 90 for t in titles) > 1 for w in longest.split()]
    if True not in marks:
        return longest
    first = marks.index(True)
    end = (marks + [False]).index(False, first)
    return " ".join(longest.split()[first:end])
