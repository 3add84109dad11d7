"""DuckDB SQL oracle: the same plans written as plain SQL over the driver
tables (views ``documents``, ``benchmark``, ``conversations`` ...).

Fragments are composed as CTE lists so every query states the whole
pipeline from the base tables.
"""

from __future__ import annotations

from sparkngram.functions import sqltwin as T


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p for p in parts if p)


def train_lines(lang: str = "en") -> str:
    return (f"lines AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line "
            f"FROM documents WHERE lang = '{lang}')")


def train_tokens() -> str:
    return f"toks AS (SELECT source, doc_id, {T.tokens(T.clean_train('line'))} AS t FROM lines)"


def grams(orders=(1, 2, 3, 4), src: str = "toks", name: str = "grams", extra: str = "") -> str:
    ol = ", ".join(str(o) for o in orders)
    return (f"{name} AS (SELECT {extra} n, array_to_string(t[i:i+n-1], '_') AS word FROM ("
            f"SELECT {extra} t, n, unnest(range(1, len(t) - n + 2)) AS i FROM {src}, "
            f"(SELECT unnest([{ol}]) AS n) ns WHERE len(t) >= n) x)")


def counts(trim: int = 1, src: str = "grams", name: str = "counts") -> str:
    having = f" HAVING count(*) >= {trim}" if trim > 1 else ""
    return (f"{name} AS (SELECT n, word, "
            f"CASE WHEN n > 1 THEN regexp_replace(word, '_[^_]+$', '') ELSE '' END AS w, "
            f"regexp_extract(word, '[^_]+$') AS pred, count(*) AS freq FROM {src} GROUP BY n, word{having})")


def sbo_model(max_order: int = 4, k: int = 5, src: str = "counts", name: str = "model") -> str:
    return (f"{name} AS ("
            f"SELECT n, w, pred, score, rnk FROM ("
            f"SELECT n, w, pred, pow(0.4, {max_order} - n) * freq / sum(freq) OVER (PARTITION BY n, w) AS score, "
            f"row_number() OVER (PARTITION BY n, w ORDER BY freq DESC, pred ASC) AS rnk "
            f"FROM {src} WHERE n BETWEEN 2 AND {max_order}) a WHERE rnk <= {k} "
            f"UNION ALL SELECT n, w, pred, score, rnk FROM ("
            f"SELECT 1 AS n, word AS w, word AS pred, freq / sum(freq) OVER () AS score, "
            f"row_number() OVER (ORDER BY freq DESC, word ASC) AS rnk FROM {src} WHERE n = 1) b WHERE rnk <= {k})")


def heldout_clean() -> str:
    return ("held AS (SELECT 'blogs' AS dataset, unnest(string_split(text, chr(10))) AS raw FROM benchmark "
            "UNION ALL SELECT 'tweets' AS dataset, unnest(string_split(text, chr(10))) AS raw "
            "FROM conversations WHERE role = 'user'),\n"
            f"hlines AS (SELECT dataset, {T.clean_eval_by('raw', 'dataset')} AS line FROM held)")


def pairs(m: int = 3) -> str:
    k = m - 1
    return ("hw AS (SELECT dataset, line, list_filter(string_split(line, ' '), lambda x: x <> '') AS ws FROM hlines),\n"
            "pairs AS (SELECT dataset, ws, pos, ws[pos + 1] AS next_word FROM ("
            "SELECT dataset, ws, unnest(range(0, len(ws) - 1)) AS pos FROM hw) p),\n"
            f"cpairs AS (SELECT dataset, CASE WHEN pos = 0 THEN '' ELSE "
            f"array_to_string(ws[pos - least(pos, {k}) + 1 : pos], ' ') END AS ctx, lower(next_word) AS next_word, "
            f"count(*) AS cnt FROM pairs GROUP BY ALL)")


def sbo_predictions(m: int = 3, k: int = 3, defaults=("the", "on", "a"), model: str = "model",
                    ctx_src: str = "(SELECT DISTINCT ctx FROM cpairs)") -> str:
    dl = ", ".join(f"('{d}', {i + 1})" for i, d in enumerate(defaults))
    return (f"ctxs AS (SELECT ctx, list_filter(string_split(ctx, ' '), lambda x: x <> '') AS cw FROM {ctx_src} c),\n"
            f"lv AS (SELECT ctx, lvl, lvl + 1 AS n, array_to_string(cw[len(cw) - lvl + 1 : len(cw)], '_') AS w FROM ("
            f"SELECT ctx, cw, unnest(range(1, least(len(cw), {m - 1}) + 1)) AS lvl FROM ctxs) z),\n"
            f"cand AS (SELECT lv.ctx, lv.lvl, m.rnk, m.pred FROM lv JOIN {model} m ON m.n = lv.n AND m.w = lv.w "
            f"WHERE m.rnk <= 3 "
            f"UNION ALL SELECT ctx, 0, d.r, d.p FROM ctxs, (VALUES {dl}) d(p, r)),\n"
            f"kf AS (SELECT ctx, pred, max(lvl) AS lvl, arg_min(rnk, (-lvl) * 1000 + rnk) AS lrnk FROM cand GROUP BY ctx, pred),\n"
            f"preds AS (SELECT ctx, pred AS word, row_number() OVER (PARTITION BY ctx ORDER BY lvl DESC, lrnk ASC) AS rnk "
            f"FROM kf QUALIFY rnk <= {k})")


def eval_report() -> str:
    return ("SELECT l.dataset AS list_name, l.line_count, l.word_count, "
            "CAST(coalesce(r.score, 0) AS BIGINT) AS score, CAST(coalesce(r.max_score, 0) AS BIGINT) AS max_score, "
            "CAST(coalesce(r.top3, 0) AS BIGINT) AS hit_count_top3, CAST(coalesce(r.top1, 0) AS BIGINT) AS hit_count_top1, "
            "CAST(coalesce(r.total, 0) AS BIGINT) AS total_count FROM "
            "(SELECT dataset, count(*) AS line_count, CAST(sum(len(list_filter(string_split(line, ' '), lambda x: x <> ''))) AS BIGINT) AS word_count "
            "FROM hlines GROUP BY dataset) l LEFT JOIN "
            "(SELECT dataset, sum(cnt * (4 - rk)) AS score, sum(cnt) * 3 AS max_score, "
            "sum(CASE WHEN rk < 4 THEN cnt ELSE 0 END) AS top3, sum(CASE WHEN rk = 1 THEN cnt ELSE 0 END) AS top1, "
            "sum(cnt) AS total FROM (SELECT c.dataset, c.cnt, coalesce(p.rnk, 4) AS rk FROM cpairs c "
            "LEFT JOIN preds p ON p.ctx = c.ctx AND p.word = c.next_word) q GROUP BY dataset) r "
            "ON l.dataset = r.dataset")


def gt_table(src: str = "kcounts", name: str = "gt") -> str:
    """Good-Turing table from untrimmed counts of orders 1..3."""
    return (f"ffq AS (SELECT c.n, r.r, CAST(count(*) FILTER (WHERE c.freq = r.r) AS DOUBLE) AS n_r, count(*) AS n_types "
            f"FROM {src} c, (SELECT unnest(range(1, 7)) AS r) r GROUP BY c.n, r.r),\n"
            f"vocab AS (SELECT CAST(count(*) AS DOUBLE) AS V FROM {src} WHERE n = 1),\n"
            f"allr AS (SELECT n, r, n_r FROM ffq UNION ALL "
            f"SELECT DISTINCT f.n, 0, CASE WHEN f.n = 1 THEN (SELECT n_r FROM ffq g WHERE g.n = 1 AND g.r = 1) "
            f"ELSE pow(v.V, f.n) - f.n_types END FROM ffq f, vocab v),\n"
            f"gtx AS (SELECT n, r, n_r, lead(n_r) OVER (PARTITION BY n ORDER BY r) AS nx, "
            f"6.0 * max(CASE WHEN r = 6 THEN n_r END) OVER (PARTITION BY n) / max(CASE WHEN r = 1 THEN n_r END) OVER (PARTITION BY n) AS k "
            f"FROM allr),\n"
            f"{name} AS (SELECT n, r, n_r, CASE WHEN r BETWEEN 1 AND 5 THEN coalesce((r + 1) * nx / nullif(r * n_r, 0), 1.0) END AS discount, "
            f"CASE WHEN r <= 5 THEN ((r + 1) * nx / nullif(n_r, 0) - r * k) / (1 - k) END AS r_star FROM gtx)")


def katz_tables(src: str = "kcounts", gt: str = "gt") -> str:
    return (f"kd AS (SELECT c.n, c.word, c.w, c.pred, c.freq, coalesce(g.discount, 1.0) AS d FROM {src} c "
            f"LEFT JOIN {gt} g ON g.n = c.n AND g.r = c.freq AND g.r BETWEEN 1 AND 5),\n"
            f"kt AS (SELECT n, w, pred, freq, d, freq * d / sum(freq) OVER (PARTITION BY n, w) AS prob, "
            f"1 - sum(freq * d) OVER (PARTITION BY n, w) / sum(freq) OVER (PARTITION BY n, w) AS leftover "
            f"FROM kd WHERE n IN (2, 3)),\n"
            f"ku AS (SELECT word, freq, d, freq * d / sum(freq) OVER () AS prob FROM kd WHERE n = 1)")


def katz_predictions(ctx_src: str, k: int = 3, defaults=("the", "to", "and")) -> str:
    """Direct form of the Katz trigram predictor over ``ctx_src(ctx)``."""
    dl = ", ".join(f"('{d}', {i + 1})" for i, d in enumerate(defaults))
    return (
        f"kc AS (SELECT ctx, list_filter(string_split(ctx, ' '), lambda x: x <> '') AS cw FROM {ctx_src} s),\n"
        "kph AS (SELECT ctx, CASE WHEN len(cw) >= 2 THEN array_to_string(cw[len(cw) - 1 : len(cw)], '_') END AS h2, "
        "CASE WHEN len(cw) >= 1 THEN cw[len(cw)] END AS h1 FROM kc),\n"
        "kph2 AS (SELECT p.*, (SELECT count(*) FROM kt WHERE n = 3 AND w = p.h2) AS t_hits, "
        "(SELECT max(leftover) FROM kt WHERE n = 3 AND w = p.h2) AS t_left, "
        "(SELECT count(*) FROM kt WHERE n = 2 AND w = p.h1) AS b_hits, "
        "(SELECT max(leftover) FROM kt WHERE n = 2 AND w = p.h1) AS b_left FROM kph p),\n"
        "kst AS (SELECT *, CASE WHEN t_hits > 0 THEN 3 ELSE 2 END AS start, "
        "CASE WHEN t_hits > 0 THEN t_hits ELSE b_hits END AS fh, CASE WHEN t_hits > 0 THEN t_left ELSE b_left END AS fl FROM kph2),\n"
        # first level rows (all of them, ranked)
        "kf AS (SELECT s.ctx, 3 AS lvl, t.pred, t.prob AS score, row_number() OVER (PARTITION BY s.ctx ORDER BY t.prob DESC, t.pred) AS rn "
        "FROM kst s JOIN kt t ON t.n = 3 AND t.w = s.h2 WHERE s.start = 3 "
        "UNION ALL SELECT s.ctx, 2, t.pred, t.prob, row_number() OVER (PARTITION BY s.ctx ORDER BY t.prob DESC, t.pred) "
        "FROM kst s JOIN kt t ON t.n = 2 AND t.w = s.h1 WHERE s.start = 2),\n"
        f"klow AS (SELECT * FROM kst WHERE fh > 0 AND fh < {k}),\n"
        "ke AS (SELECT f.ctx, f.pred FROM kf f JOIN klow l ON l.ctx = f.ctx),\n"
        # bigram remain under a trigram start
        "kb AS (SELECT l.ctx, t.pred, t.freq * t.d / sum(t.freq) OVER (PARTITION BY l.ctx) AS p0, t.prob, "
        "t.freq * t.d AS fd FROM klow l JOIN kt t ON t.n = 2 AND t.w = l.h1 WHERE l.start = 3),\n"
        "kbr AS (SELECT b.* FROM kb b WHERE NOT EXISTS (SELECT 1 FROM ke e WHERE e.ctx = b.ctx AND e.pred = b.pred)),\n"
        "kb2 AS (SELECT r.ctx, r.pred, r.prob, r.prob * l.t_left / sum(r.p0) OVER (PARTITION BY r.ctx) AS score FROM kbr r JOIN klow l ON l.ctx = r.ctx),\n"
        "kb3 AS (SELECT ctx, 2 AS lvl, pred, score, row_number() OVER (PARTITION BY ctx ORDER BY prob DESC, pred) AS rn FROM kb2),\n"
        # unigram remain
        "ku_all AS (SELECT sum(freq) AS sf FROM ku),\n"
        "kur AS (SELECT l.ctx, u.word AS pred, u.prob, u.freq * u.d / a.sf AS p0 FROM klow l, ku u, ku_all a "
        "WHERE NOT EXISTS (SELECT 1 FROM ke e WHERE e.ctx = l.ctx AND e.pred = u.word)),\n"
        "ku2 AS (SELECT r.ctx, r.pred, r.prob, r.prob * l.fl / sum(r.p0) OVER (PARTITION BY r.ctx) AS score FROM kur r JOIN klow l ON l.ctx = r.ctx),\n"
        "ku3 AS (SELECT ctx, 1 AS lvl, pred, score, row_number() OVER (PARTITION BY ctx ORDER BY prob DESC, pred) AS rn FROM ku2 QUALIFY rn <= 10),\n"
        f"kcand AS (SELECT ctx, lvl, pred, score, rn FROM kf WHERE rn <= {k} UNION ALL SELECT * FROM kb3 UNION ALL SELECT * FROM ku3),\n"
        "kkf AS (SELECT ctx, pred, max(lvl) AS lvl, arg_min(rn, (-lvl) * 1000000 + rn) AS lrn, arg_min(score, (-lvl) * 1000000 + rn) AS score "
        "FROM kcand GROUP BY ctx, pred),\n"
        f"kr AS (SELECT ctx, pred AS word, score, row_number() OVER (PARTITION BY ctx ORDER BY lvl DESC, lrn) AS rnk FROM kkf QUALIFY rnk <= {k}),\n"
        f"kfull AS (SELECT ctx FROM kr GROUP BY ctx HAVING count(*) >= {k}),\n"
        f"kpreds AS (SELECT ctx, rnk, word, score FROM kr WHERE ctx IN (SELECT ctx FROM kfull) "
        f"UNION ALL SELECT c.ctx, d.r, d.p, NULL FROM kc c, (VALUES {dl}) d(p, r) WHERE c.ctx NOT IN (SELECT ctx FROM kfull))")


def sbo_variant(kind: str, k: int = 3, per_level: int = 3, defaults=("the", "on", "a"), model: str = "model",
                ctx_src: str = "(SELECT DISTINCT ctx FROM cpairs)", m: int = 3) -> str:
    """Predictor variants: ``unigram`` fill (G3), ``first_hit`` (G4),
    ``none`` (G6: no fill), all over ``ctx_src(ctx)``."""
    dl = ", ".join(f"('{d}', {i + 1})" for i, d in enumerate(defaults))
    base = (f"vctx AS (SELECT ctx, list_filter(string_split(ctx, ' '), lambda x: x <> '') AS cw FROM {ctx_src} c),\n"
            f"vlv AS (SELECT ctx, lvl, lvl + 1 AS n, array_to_string(cw[len(cw) - lvl + 1 : len(cw)], '_') AS w FROM ("
            f"SELECT ctx, cw, unnest(range(1, least(len(cw), {m - 1}) + 1)) AS lvl FROM vctx) z),\n"
            f"vhit AS (SELECT v.ctx, v.lvl, mm.rnk, mm.pred FROM vlv v JOIN {model} mm ON mm.n = v.n AND mm.w = v.w "
            f"WHERE mm.rnk <= {per_level}),\n")
    empty = f"SELECT c.ctx, 0, d.r, d.p FROM vctx c, (VALUES {dl}) d(p, r) WHERE c.ctx = ''"
    if kind == "unigram":
        fill = (f"UNION ALL SELECT c.ctx, 0, mm.rnk, mm.pred FROM vctx c, {model} mm WHERE c.ctx <> '' AND mm.n = 1 "
                f"AND mm.rnk <= {per_level} UNION ALL {empty}")
        cand = f"vcand AS (SELECT * FROM vhit {fill}),\n"
    elif kind == "first_hit":
        cand = (f"vbest AS (SELECT ctx, max(lvl) AS b FROM vhit GROUP BY ctx),\n"
                f"vcand AS (SELECT h.* FROM vhit h JOIN vbest b ON b.ctx = h.ctx AND b.b = h.lvl "
                f"UNION ALL SELECT c.ctx, 0, d.r, d.p FROM vctx c, (VALUES {dl}) d(p, r) "
                f"WHERE c.ctx NOT IN (SELECT ctx FROM vbest)),\n")
    else:
        cand = f"vcand AS (SELECT * FROM vhit UNION ALL {empty}),\n"
    return (base + cand +
            "vkf AS (SELECT ctx, pred, max(lvl) AS lvl, arg_min(rnk, (-lvl) * 1000 + rnk) AS lrnk FROM vcand GROUP BY ctx, pred),\n"
            f"vpreds AS (SELECT ctx, pred AS word, row_number() OVER (PARTITION BY ctx ORDER BY lvl DESC, lrnk ASC) AS rnk "
            f"FROM vkf QUALIFY rnk <= {k})")
