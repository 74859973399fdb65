"""The streamed audit against a plain recount in every order of the five filters."""

from itertools import permutations

from llm_support import Counter, corpus, random, re

from plantmetrics.llm import filter_audit

SCHEMA = "doc_id long, text string, lang string, part string, mask int, n long"


def failing(rows):
    """(part, set of failed filters, doc_id) of each row, straight from the definitions."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        checks = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                  "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > least.get(t, i)}
        yield lang or "", {k for k, v in checks.items() if v}, i


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, x in labels if x == 1} - {None}
    found = list(failing(rows))
    out, removed = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {p for p, _, _ in found}:
            left = [x for x in found if x[0] == part]
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[1]]
                fails = [x for x in found if x[0] == part and f in x[1]]
                left = [x for x in left if f not in x[1]]
                removed[part, f] += len(here)
                out[part, order, step] = [len(left), len(here), len(fails) - len(here), sum(x[1] == {f} for x in fails),
                                          sum(x[2] in good for x in here), sum(x[2] in toxic for x in here), f]
    return {k: (*v[:-1], removed[k[0], v[-1]]) for k, v in out.items()}


def documents(seed=1, n=60):
    """Copies whose least id comes first, last or between; nulls, repeated rows, long and empty texts."""
    r = random.Random(seed)
    texts = [t for _, t, _ in corpus(seed, 40)] + ["A B C", "x " * 400, "ÉA" * 9, "# one"]
    rows = [(i, r.choice(texts), r.choice(["en", "de", None])) for i in r.sample(range(10 * n), n)]
    rows += [(None, "A B C", "en"), (-5, "x " * 400, "de"), rows[3], rows[3], (7, None, "en"), (6, "", "fr")]
    r.shuffle(rows)
    return rows


def told(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(x.part, x.filter_order, x.step): tuple(x[c] for c in names) for x in df.collect()}


def write(spark, path, rows, files):
    for k in range(files):
        data = [(i, t, lang, "clash", 1, 2) for i, t, lang in rows[k::files]]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def labelled(spark, rows):
    labels = [(i, i % 2, int(i % 3 == 0)) for i, _, _ in rows if i is not None and i % 4]
    labels += [(labels[0][0], None, 1), (10 ** 6, 1, 1), (None, 1, 1)]
    return labels, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_audit_equals_a_recount_for_any_number_of_micro_batches(spark, tmp_path):
    rows = documents()
    labels, frame = labelled(spark, rows)
    path = str(tmp_path / "documents.parquet")
    write(spark, path, rows, 3)
    expected = brute(rows, labels)
    for batches, bucket_rows in ((3, 8192), (1, 3)):
        got = filter_audit.filter_audit(spark, path, frame, batches, bucket_rows)
        assert [f for f, _ in got.dtypes][:3] == ["part", "filter_order", "step"]
        assert told(got) == expected


def test_restarted_stream_retracts_what_smaller_ids_change(spark, tmp_path):
    """First the larger ids, then, in a second run of the same stream, the smaller ones."""
    rows = sorted(documents(2), key=lambda x: -(x[0] if x[0] is not None else 10 ** 9))
    labels, frame = labelled(spark, rows)
    path, root = str(tmp_path / "documents.parquet"), str(tmp_path / "stream")
    write(spark, path, rows[:30], 1)
    filter_audit.run_stream(spark, path, frame, root, 4, 1)
    first = told(filter_audit.audit(filter_audit.counters(spark, root)))
    assert first == brute(rows[:30], labels)
    write(spark, path, rows[30:], 2)
    filter_audit.run_stream(spark, path, frame, root, 4, 1)
    assert told(filter_audit.audit(filter_audit.counters(spark, root))) == brute(rows, labels)
    taken_back = spark.read.parquet(f"{root}/deltas").filter("n < 0").count()
    assert taken_back > 0


def test_empty_table_gives_no_rows(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    write(spark, path, [], 1)
    _, frame = labelled(spark, documents())
    assert filter_audit.filter_audit(spark, path, frame).count() == 0


def test_one_file_is_a_table_too(spark):
    from llm_support import SF

    got = filter_audit.filter_audit(spark, f"{SF}/documents.parquet", spark.read.parquet(f"{SF}/labels.parquet"))
    per = {r["sum(removed)"] + 0 for r in got.filter("step = 1").groupBy("part", "filter_order").sum("removed").collect()}
    assert per and got.count() % 600 == 0


def test_very_long_text(spark, tmp_path):
    rows = [(2, "word " * 1_500_000, "en"), (1, "word " * 1_500_000, "en"), (3, "W" * 6_000_000, "en")]
    labels, frame = labelled(spark, rows)
    path = str(tmp_path / "documents.parquet")
    write(spark, path, rows, 2)
    assert told(filter_audit.filter_audit(spark, path, frame)) == brute(rows, labels)
