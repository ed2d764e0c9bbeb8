"""Content metrics against a plain computation, with a title that holds a third
of all views."""

from collections import Counter
from decimal import Decimal

from churnlab.plans import content as CT


def test_completion_and_segments_match_plain_python(spark):
    titles = [(i, f"g{i % 4}", "movie" if i % 2 else "series") for i in range(20)]
    views = [(u, 0 if u % 3 == 0 else (u * 7 + k) % 23, Decimal(k % 5) / 4, k % 5 == 4) for u in range(300) for k in range(1 + u % 6)]
    catalog = spark.createDataFrame(titles, "content_id bigint, genre string, content_type string")
    seen = spark.createDataFrame(views, "user_id bigint, content_id bigint, watch_percentage decimal(4,2), completed boolean").repartition(4)
    known = {t: (g, c) for t, g, c in titles}

    rows = {(r.genre, r.content_type): r for r in CT.content_completion(seen, catalog).collect()}
    groups = {}
    for _, t, w, done in views:
        if t in known:
            groups.setdefault(known[t], []).append((w, done))
    assert set(rows) == set(groups)
    for key, each in groups.items():
        r = rows[key]
        assert (r.views, r.completed_views) == (len(each), sum(d for _, d in each))
        assert abs(r.avg_watch_percentage - float(sum(w for w, _ in each)) / len(each)) < 1e-12

    top = {}
    for u in range(300):
        count = Counter(known[t][0] for v, t, _, _ in views if v == u and t in known)
        if count:
            top[u] = min(count, key=lambda g: (-count[g], g))
    outcomes = [(u, "AN"[u % 2], int(u % 5 == 0), int(u % 7 == 0)) for u in range(310)]
    out = spark.createDataFrame(outcomes, "user_id bigint, primary_device string, retained_d7 int, retained_d30 int")
    found = {(r.segment_type, r.segment): (r.users, r.d7_rate, r.d30_rate) for r in CT.retention_by_segment(out, seen, catalog).collect()}
    expected = {}
    for kind, of in (("primary_device", lambda u: "AN"[u % 2]), ("top_genre", top.get)):
        for segment in {of(u) for u, *_ in outcomes} - {None}:
            members = [o for o in outcomes if of(o[0]) == segment]
            expected[kind, segment] = (len(members), sum(m[2] for m in members) / len(members), sum(m[3] for m in members) / len(members))
    assert found == expected
