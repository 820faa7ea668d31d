"""DuckDB SQL with the same results as the registered queries, written independently of the Spark code."""

from __future__ import annotations

WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
NUM = rf"^{WS}*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?{WS}*$"
CASE_RE = rf"(?i)(\p{{Nd}}[\p{{Nd}},]*){WS}+(?:confirmed{WS}+|suspected{WS}+)?cases?"
DEATH_RE = rf"(?i)(\p{{Nd}}[\p{{Nd}},]*){WS}+deaths?"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def _raw(event_type: str, column: str) -> str:
    return f"""
SELECT CASE WHEN user_id % 37 = 36 THEN NULL
            WHEN user_id % 31 = 9 THEN 'Zoen_' || CAST(user_id AS VARCHAR)
            WHEN user_id % 13 = 5 THEN 'Zne_' || CAST(user_id AS VARCHAR)
            WHEN user_id % 7 = 3 THEN '  Zone_' || CAST(user_id AS VARCHAR) || ' '
            ELSE 'Zone_' || CAST(user_id AS VARCHAR) END AS nom,
       CASE WHEN (user_id + day(d)) % 19 = 0 THEN CAST(d AS VARCHAR) || ']' ELSE CAST(d AS VARCHAR) END AS date,
       CASE WHEN (user_id * 31 + day(d)) % 17 = 0 THEN 'ND'
            WHEN (user_id + day(d)) % 41 = 0 THEN CAST(cum AS VARCHAR) || '-'
            ELSE CAST(cum AS VARCHAR) END AS {column}
FROM (SELECT user_id, d, 5 + SUM(n) OVER (PARTITION BY user_id ORDER BY d)
             - CASE WHEN (user_id + day(d)) % 23 = 0 THEN 1 ELSE 0 END AS cum
      FROM (SELECT user_id, CASE WHEN user_id % 17 = 2 THEN CAST(date_trunc('week', ts) AS DATE) ELSE CAST(ts AS DATE) END AS d,
                   SUM(CASE WHEN event_type = '{event_type}' THEN 1 ELSE 0 END) AS n
            FROM events GROUP BY 1, 2))"""


def _clean(source: str, column: str) -> str:
    return f"""
SELECT r.nom, coalesce(a.canonical_nom, trim(r.nom)) AS nom_clean,
       CAST(replace(r.date, ']', '') AS DATE) AS date,
       TRY_CAST(r.{column} AS DOUBLE) AS {column}
FROM {source} r LEFT JOIN aliases a ON trim(r.nom) = a.observed_name
WHERE r.nom IS NOT NULL"""


def _twice(source: str, column: str) -> str:
    second = f"coalesce(CAST(TRY_CAST({column} AS BIGINT) + 3 AS VARCHAR), {column}) AS {column}"
    both = f"SELECT * FROM {source} UNION ALL SELECT replace(nom, 'Zne_', 'Zone_') AS nom, date, {second} FROM {source} WHERE nom LIKE 'Zne_%'"
    return _clean(f"({both})", column)


def _mentions(pattern: str, kind: str, first: int) -> str:
    return f"""
SELECT bulletin, {first} AS part, i, '{kind}' AS type,
       TRY_CAST(replace(n[i], ',', '') AS BIGINT) AS value,
       text, length(w[i]) AS size,
       CAST(coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)
         + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
FROM (SELECT bulletin, text, w, n, p, unnest(generate_series(1, len(w))) AS i
      FROM (SELECT bulletin, text, regexp_extract_all(text, '{pattern}') AS w,
                   regexp_extract_all(text, '{pattern}', 1) AS n,
                   string_split_regex(text, '{pattern}') AS p
            FROM bulletins) WHERE len(w) > 0)"""


def _page_text(region: str) -> str:
    """Text of a region of the test pages; some of them leave the body open."""
    lazy, end = ("?", "|$") if region == "body" else ("", "")
    return rf"""
SELECT page_id, array_to_string(list_filter(list_transform(string_split(
         replace(replace(replace(replace(
           regexp_replace(regexp_replace(regexp_extract(regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', chr(1), 'g'),
             '(?s)<{region}[^>]*>(.*{lazy})(?:</{region}>{end})', 1), '(?s)<(nav|header|footer)[^a-z].*?</(nav|header|footer)>', chr(1), 'g'),
             '<[^>]*>', chr(1), 'g'),
         '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&'), chr(1)),
       lambda x: {_strip("x")}), lambda x: length(x) > 0), chr(10)) AS article
FROM pages"""


def _stems(pattern: str) -> str:
    return f"len(regexp_extract_all(paragraph, '(?i){pattern}'))"


def _severity_step(before: str, after: str) -> str:
    """One step: shares of terms, then shares of paragraphs by seed and terms."""
    return f"""
{after}_terms AS (
  SELECT cell, sum(s0) AS s0, sum(s1) AS s1, sum(s2) AS s2
  FROM (SELECT unnest(cells) AS cell, s0, s1, s2 FROM {before}) GROUP BY cell
), {after}_all AS (
  SELECT sum(s0) AS t0, sum(s1) AS t1, sum(s2) AS t2, count(*) AS n FROM {after}_terms
), {after}_logs AS (
  SELECT bulletin, pos, sum(ln((t.s0 + 0.5) / (t0 + 0.5 * n))) AS l0, sum(ln((t.s1 + 0.5) / (t1 + 0.5 * n))) AS l1,
         sum(ln((t.s2 + 0.5) / (t2 + 0.5 * n))) AS l2
  FROM (SELECT bulletin, pos, unnest(cells) AS cell FROM {before}) JOIN {after}_terms t USING (cell), {after}_all GROUP BY ALL
), {after}_sums AS (
  SELECT b.*, ln(seed0) + coalesce(l0, 0) AS g0, ln(seed1) + coalesce(l1, 0) AS g1, ln(seed2) + coalesce(l2, 0) AS g2
  FROM {before} b LEFT JOIN {after}_logs USING (bulletin, pos)
), {after} AS MATERIALIZED (
  SELECT bulletin, pos, cells, seed0, seed1, seed2,
         round(exp(g0 - greatest(g0, g1, g2)) / (exp(g0 - greatest(g0, g1, g2)) + exp(g1 - greatest(g0, g1, g2)) + exp(g2 - greatest(g0, g1, g2))), 9) AS s0,
         round(exp(g1 - greatest(g0, g1, g2)) / (exp(g0 - greatest(g0, g1, g2)) + exp(g1 - greatest(g0, g1, g2)) + exp(g2 - greatest(g0, g1, g2))), 9) AS s1,
         round(exp(g2 - greatest(g0, g1, g2)) / (exp(g0 - greatest(g0, g1, g2)) + exp(g1 - greatest(g0, g1, g2)) + exp(g2 - greatest(g0, g1, g2))), 9) AS s2
  FROM {after}_sums
)"""


SEVERITY_SEEDS = f"""
, weighed AS (
  SELECT bulletin, pos, list_distinct(list_transform(list_distinct(regexp_extract_all(lower(paragraph), '[\\p{{L}}\\p{{M}}\\p{{N}}_''’-]+')),
           lambda w: ('0x' || substr(md5(w), 1, 5))::INT)) AS cells,
         CAST(1.0 AS DOUBLE) + {_stems("update|routine|recover|follow-up|monitor|discharged")} AS h0,
         CAST(0.5 AS DOUBLE) + {_stems("increas|escalat|spread|rising|expand|surge|intensif|additional")} AS h1,
         CAST(0.5 AS DOUBLE) + {_stems("emergenc|crisis|death|fatal|mortality|international concern")} AS h2
  FROM paras
), step0 AS MATERIALIZED (
  SELECT bulletin, pos, cells, round(h0 / (h0 + h1 + h2), 9) AS seed0, round(h1 / (h0 + h1 + h2), 9) AS seed1,
         round(h2 / (h0 + h1 + h2), 9) AS seed2, seed0 AS s0, seed1 AS s1, seed2 AS s2 FROM weighed
),"""


# Common tables: name -> (tables it reads, SQL).
VIEWS: dict[str, tuple[list[str], str]] = {
    "raw_cases": ([], _raw("error", "cumulative_confirmed_cases")),
    "raw_deaths": ([], _raw("signup", "cumulative_confirmed_deaths")),
    "aliases": (
        [],
        """
SELECT DISTINCT 'Zne_' || CAST(user_id AS VARCHAR) AS observed_name,
       'Zone_' || CAST(user_id AS VARCHAR) AS canonical_nom FROM events WHERE user_id % 13 = 5""",
    ),
    "health_zones": (
        [],
        """
SELECT 'Zone_' || CAST(c_custkey AS VARCHAR) AS nom, r_name AS province,
       CASE WHEN c_custkey % 11 = 4 THEN NULL ELSE abs(c_acctbal) END AS population_density,
       CAST(c_nationkey AS DOUBLE) / 8 AS healthsite_density,
       CAST(300 + 40 * n_nationkey AS DOUBLE) AS gdp_per_capita
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "clean_cases": (
        ["raw_cases", "aliases"],
        f"SELECT * FROM ({_clean('raw_cases', 'cumulative_confirmed_cases')}) WHERE cumulative_confirmed_cases IS NOT NULL",
    ),
    "clean_deaths": (["raw_deaths", "aliases"], _clean("raw_deaths", "cumulative_confirmed_deaths")),
    "daily": (
        ["clean_cases"],
        """
SELECT nom_clean, nom, date, cumulative_confirmed_cases,
       greatest(coalesce(cumulative_confirmed_cases - lag(cumulative_confirmed_cases)
         OVER (PARTITION BY nom_clean ORDER BY date), 0), 0) AS new_cases
FROM clean_cases""",
    ),
    "weekly": (
        ["daily"],
        """
SELECT *, SUM(new_cases) OVER (PARTITION BY nom_clean ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7
FROM daily""",
    ),
    "series": (
        ["weekly"],
        """
SELECT * EXCLUDE (prev), CASE WHEN prev > 0 THEN rolling_7 / prev END AS rt_proxy
FROM (SELECT *, lag(rolling_7, 7) OVER (PARTITION BY nom_clean ORDER BY date) AS prev FROM weekly)""",
    ),
    "inputs": (
        ["series"],
        """
SELECT *, row_number() OVER w - 1 AS day_idx, COUNT(*) OVER (PARTITION BY nom_clean) AS zone_rows,
       SUM(new_cases) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
         / COUNT(*) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3d_new_cases
FROM series WINDOW w AS (PARTITION BY nom_clean ORDER BY date)""",
    ),
    "trend": (
        ["series"],
        """
SELECT nom_clean, date, rolling_7 AS rolling_7d_new_cases,
       date - MIN(date) OVER (PARTITION BY nom_clean) AS days_since_first_case,
       date - coalesce(MAX(CASE WHEN new_cases > 0 THEN date END)
           OVER (PARTITION BY nom_clean ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         MIN(date) OVER (PARTITION BY nom_clean)) AS days_since_last_case
FROM series""",
    ),
    "outlook": (
        ["series"],
        """
SELECT s.nom_clean, s.date,
       CASE WHEN EXISTS (SELECT 1 FROM series f WHERE f.nom_clean = s.nom_clean AND f.new_cases > 0
                         AND f.date > s.date AND f.date <= s.date + 7) THEN 1 ELSE 0 END AS label_next_7d_onset,
       (SELECT MAX(l.date) FROM series l WHERE l.nom_clean = s.nom_clean) >= s.date + 7 AS has_full_future_window
FROM series s""",
    ),
    "density": (
        ["clean_cases", "health_zones"],
        """
SELECT c.nom_clean, c.date, z.population_density AS known,
       coalesce(z.population_density, (SELECT median(y.population_density) FROM clean_cases b
         JOIN health_zones y ON b.nom_clean = y.nom), 0) AS population_density,
       CASE WHEN z.population_density IS NULL THEN 1 ELSE 0 END AS population_density_was_missing
FROM clean_cases c LEFT JOIN health_zones z ON c.nom_clean = z.nom""",
    ),
    "labelled": (
        ["series", "trend", "outlook", "density"],
        """
SELECT s.nom_clean, s.date, s.cumulative_confirmed_cases, s.new_cases, s.rt_proxy, d.population_density,
       d.population_density_was_missing, t.rolling_7d_new_cases, t.days_since_first_case, t.days_since_last_case,
       o.label_next_7d_onset, o.has_full_future_window
FROM series s JOIN trend t USING (nom_clean, date) JOIN outlook o USING (nom_clean, date)
JOIN density d USING (nom_clean, date) WHERE o.has_full_future_window""",
    ),
    "split": (
        ["labelled"],
        """
SELECT *, date < (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i,
                                           COUNT(*) OVER () AS n FROM labelled)
                  WHERE i = CAST(floor(CAST(n AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS BIGINT)) AS is_train
FROM labelled""",
    ),
    "national": (
        ["clean_cases", "clean_deaths"],
        """
SELECT coalesce(c.date, d.date) AS date, c.n AS national_cumulative_confirmed_cases,
       d.n AS national_cumulative_confirmed_deaths
FROM (SELECT date, SUM(cumulative_confirmed_cases) AS n FROM clean_cases GROUP BY date) c
FULL JOIN (SELECT date, SUM(cumulative_confirmed_deaths) AS n FROM clean_deaths GROUP BY date) d ON c.date = d.date""",
    ),
    "twice_cases": (["raw_cases", "aliases"], _twice("raw_cases", "cumulative_confirmed_cases")),
    "twice_deaths": (["raw_deaths", "aliases"], _twice("raw_deaths", "cumulative_confirmed_deaths")),
    "twice_series": (
        ["twice_cases"],
        """
SELECT * EXCLUDE (prev), CASE WHEN prev > 0 THEN rolling_7 / prev END AS rt_proxy
FROM (SELECT *, lag(rolling_7, 7) OVER (PARTITION BY nom_clean ORDER BY zone_row) AS prev
      FROM (SELECT *, SUM(new_cases) OVER (PARTITION BY nom_clean ORDER BY zone_row ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7
            FROM (SELECT nom_clean, date, cumulative_confirmed_cases, row_number() OVER w - 1 AS zone_row,
                         greatest(coalesce(cumulative_confirmed_cases - lag(cumulative_confirmed_cases) OVER w, 0), 0) AS new_cases
                  FROM twice_cases WHERE cumulative_confirmed_cases IS NOT NULL
                  WINDOW w AS (PARTITION BY nom_clean ORDER BY date, nom, cumulative_confirmed_cases))))""",
    ),
    # One-class SVM: distinct baseline points, then pairwise descent on the dual over lists.
    "usable": (["inputs"], "SELECT * FROM inputs WHERE zone_rows >= 21"),
    "scaling": (
        ["usable"],
        """
SELECT avg(new_cases) AS mx, avg(rolling_3d_new_cases) AS my,
       CASE WHEN stddev_pop(new_cases) > 0 THEN stddev_pop(new_cases) ELSE 1 END AS sx,
       CASE WHEN stddev_pop(rolling_3d_new_cases) > 0 THEN stddev_pop(rolling_3d_new_cases) ELSE 1 END AS sy,
       1.0 / (CASE WHEN stddev_pop(new_cases) > 0 THEN 1 ELSE 0 END
              + CASE WHEN stddev_pop(rolling_3d_new_cases) > 0 THEN 1 ELSE 0 END) AS gamma,
       COUNT(*) AS n
FROM usable WHERE day_idx < 14""",
    ),
    "points": (
        ["usable", "scaling"],
        """
SELECT x, y, c, greatest(least(CAST(0.1 AS DOUBLE) - (SUM(c) OVER (ORDER BY c DESC, x, y ROWS UNBOUNDED PRECEDING) - c), c), 0.0) AS a
FROM (SELECT (new_cases - mx) / sx AS x, (rolling_3d_new_cases - my) / sy AS y, CAST(COUNT(*) AS DOUBLE) / max(n) AS c
      FROM usable, scaling WHERE day_idx < 14 GROUP BY 1, 2)""",
    ),
    "problem": (
        ["points", "scaling"],
        """
SELECT xs, ys, cs, a0, list_transform(generate_series(1, len(xs)), lambda i: list_transform(generate_series(1, len(xs)),
         lambda j: exp(-gamma * ((xs[i] - xs[j]) ** 2 + (ys[i] - ys[j]) ** 2)))) AS k
FROM scaling, (SELECT list(x ORDER BY c DESC, x, y) AS xs, list(y ORDER BY c DESC, x, y) AS ys,
             list(c ORDER BY c DESC, x, y) AS cs, list(a ORDER BY c DESC, x, y) AS a0 FROM points)""",
    ),
    "descent": (
        ["problem"],
        """
SELECT 0 AS it, p.a0 AS a,
       list_transform(p.k, lambda r: list_sum(list_transform(p.a0, lambda v, t: v * r[t]))) AS g FROM problem p
UNION ALL
SELECT it + 1,
       list_transform(a, lambda v, t: CASE WHEN t = i THEN (CASE WHEN step = cs[i] - a[i] THEN cs[i] ELSE v + step END)
                                           WHEN t = j THEN v - step ELSE v END),
       list_transform(g, lambda v, t: v + step * (k[i][t] - k[j][t]))
FROM (SELECT *, least((g[j] - g[i]) / greatest(2 - 2 * k[i][j], 1e-12), cs[i] - a[i], a[j]) AS step
      FROM (SELECT it, a, g, cs, k, list_position(up, list_min(up)) AS i, list_position(down, list_max(down)) AS j
            FROM (SELECT s.it, s.a, s.g, p.cs, p.k,
                         list_transform(s.g, lambda v, t: CASE WHEN s.a[t] < p.cs[t] THEN v ELSE 1e300 END) AS up,
                         list_transform(s.g, lambda v, t: CASE WHEN s.a[t] > 0 THEN v ELSE -1e300 END) AS down
                  FROM descent s, problem p)))
WHERE g[j] - g[i] > 2e-14""",
    ),
    "solution": (
        ["descent", "problem"],
        """
SELECT d.a, p.xs, p.ys,
       coalesce(list_avg(list_filter(d.g, lambda v, t: d.a[t] > 0 AND d.a[t] < p.cs[t])),
                (list_max(list_filter(d.g, lambda v, t: d.a[t] >= p.cs[t]))
                 + list_min(list_filter(d.g, lambda v, t: d.a[t] <= 0))) / 2) AS rho
FROM (SELECT arg_max(a, it) AS a, arg_max(g, it) AS g FROM descent) d, problem p""",
    ),
    "scores": (
        ["usable", "scaling", "solution"],
        """
SELECT * EXCLUDE (value, rho), CASE WHEN abs(value) < 1e-7 * abs(rho) THEN 0.0 ELSE value END AS anomaly_score
FROM (SELECT u.*, s.n * m.rho AS rho, s.n * (m.rho - list_sum(list_transform(m.a, lambda v, t: v * exp(-s.gamma * (
         ((u.new_cases - s.mx) / s.sx - m.xs[t]) ** 2 + ((u.rolling_3d_new_cases - s.my) / s.sy - m.ys[t]) ** 2))))) AS value
      FROM usable u, scaling s, solution m)""",
    ),
    "latest_scores": (
        ["scores"],
        "SELECT nom_clean AS nom, max(date) AS date, arg_max(anomaly_score, date) AS anomaly_score FROM scores GROUP BY nom_clean",
    ),
    "ranked": (
        ["latest_scores", "health_zones"],
        """
SELECT s.nom AS zone, province, province IN ('ASIA', 'EUROPE') AS cross_border_watch, CAST(s.date AS VARCHAR) AS date,
       round(anomaly_score, 4) AS anomaly_score, anomaly_score AS exact
FROM latest_scores s JOIN health_zones z ON s.nom = z.nom""",
    ),
    "top200": (
        ["ranked"],
        "SELECT * FROM (SELECT *, row_number() OVER (ORDER BY exact DESC, zone) AS rank FROM ranked) WHERE rank <= 200",
    ),
    "evaluation": (
        ["scores"],
        """
SELECT nom_clean, date, anomaly_score, CASE WHEN rt_proxy > 2 THEN 1 ELSE 0 END AS true_surge,
       CASE WHEN anomaly_score > 0 THEN 1 ELSE 0 END AS flagged
FROM scores WHERE day_idx >= 14 AND rt_proxy IS NOT NULL""",
    ),
    "curve": (
        ["evaluation"],
        """
SELECT threshold, pos, SUM(pos) OVER w AS tp, SUM(n) OVER w AS flagged_rows, SUM(pos) OVER () AS all_pos
FROM (SELECT anomaly_score AS threshold, SUM(true_surge) AS pos, COUNT(*) AS n FROM evaluation GROUP BY 1)
WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)""",
    ),
    "bulletins": (
        [],
        """
SELECT 'DON' || lpad(CAST(600 + doc_id AS VARCHAR), 9, '0') || '_' || CAST(DATE '2026-01-01' + CAST(doc_id % 365 AS INTEGER) AS VARCHAR) AS bulletin,
       text || chr(10) || 'As of day ' || CAST(doc_id AS VARCHAR) || ' a total of ' || CAST(n_chars AS VARCHAR)
       || ' confirmed cases, including ' || CAST(n_chars % 97 AS VARCHAR) || ' deaths, were reported in zone Zone_'
       || CAST(doc_id % 40 AS VARCHAR) || '.' AS text
FROM documents""",
    ),
    "mentions": (
        ["bulletins"],
        f"""
SELECT bulletin, row_number() OVER (PARTITION BY bulletin ORDER BY part, i) - 1 AS pos, value, type,
       '...' || {_strip("replace(substring(text, greatest(start - 60, 0) + 1, start + size + 20 - greatest(start - 60, 0)), chr(10), ' ')")}
       || '...' AS context
FROM ({_mentions(CASE_RE, "cases", 0)} UNION ALL {_mentions(DEATH_RE, "deaths", 1)})""",
    ),
    "paras": (
        ["bulletins"],
        f"""
SELECT bulletin, row_number() OVER (PARTITION BY bulletin ORDER BY i) - 1 AS pos, paragraph
FROM (SELECT bulletin, i, {_strip("lines[i]")} AS paragraph
      FROM (SELECT bulletin, lines, unnest(generate_series(1, len(lines))) AS i
            FROM (SELECT bulletin, string_split(text, chr(10)) AS lines FROM bulletins)))
WHERE length(paragraph) > 60""",
    ),
    "judged": (
        ["paras"],
        f"""
SELECT bulletin, pos, paragraph,
       CASE WHEN e = greatest(r, s, e) THEN 'emergency-level crisis' WHEN s = greatest(r, s, e) THEN 'concerning escalation'
            ELSE 'routine update' END AS label,
       round(greatest(r, s, e) / (r + s + e), 3) AS confidence
FROM (SELECT *, CAST(1.0 AS DOUBLE) + {_stems("update|routine|recover|follow-up|monitor|discharged")} AS r,
             CAST(0.5 AS DOUBLE) + {_stems("increas|escalat|spread|rising|expand|surge|intensif|additional")} AS s,
             CAST(0.5 AS DOUBLE) + {_stems("emergenc|crisis|death|fatal|mortality|international concern")} AS e
      FROM paras)""",
    ),
    "worst": (
        ["judged"],
        """
SELECT bulletin, CASE WHEN length(paragraph) > 150 THEN left(paragraph, 150) || '...' ELSE paragraph END AS paragraph, label, confidence
FROM (SELECT *, row_number() OVER (PARTITION BY bulletin ORDER BY
        CASE WHEN label = 'emergency-level crisis' THEN confidence ELSE 0 END DESC, pos) AS rn FROM judged) WHERE rn = 1""",
    ),
    "places": (
        ["bulletins", "health_zones"],
        r"""
SELECT bulletin, list_sort(list(DISTINCT name)) AS names
FROM (SELECT bulletin, unnest(list_distinct(list_concat(w, list_transform(generate_series(1, len(w) - 1),
             lambda i: w[i] || ' ' || w[i + 1])))) AS gram
      FROM (SELECT bulletin, regexp_extract_all(text, '[\p{L}\p{M}\p{N}_''’-]+') AS w FROM bulletins))
JOIN (SELECT nom AS name FROM health_zones UNION SELECT province FROM health_zones) ON gram = name
GROUP BY bulletin""",
    ),
    "headlines": (
        ["bulletins", "mentions", "places", "worst"],
        """
SELECT b.bulletin, m.max_cases, m.max_deaths, coalesce(len(p.names), 0) AS locations, w.paragraph, w.label, w.confidence,
       CASE w.label WHEN 'emergency-level crisis' THEN 'crisis' WHEN 'concerning escalation' THEN 'escalation'
                    WHEN 'routine update' THEN 'routine' END AS severity_class
FROM bulletins b
LEFT JOIN (SELECT bulletin, MAX(CASE WHEN type = 'cases' THEN value END) AS max_cases,
                  MAX(CASE WHEN type = 'deaths' THEN value END) AS max_deaths FROM mentions GROUP BY 1) m USING (bulletin)
LEFT JOIN places p USING (bulletin) LEFT JOIN worst w USING (bulletin)""",
    ),
    "page_text": ([], _page_text("article")),
    "body_text": ([], _page_text("body")),
}


def _sql(final: str, *reads: str) -> str:
    """`final` behind the common tables it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in VIEWS[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in reads:
        visit(name)
    tables = ",\n".join(
        f"{n} AS {'' if n == 'descent' else 'MATERIALIZED '}({VIEWS[n][1]})" for n in ordered
    )
    return f"WITH RECURSIVE {tables}\n{final}" if tables else final


ISO = "CAST(date AS VARCHAR) AS date"
KEY = f"nom_clean, {ISO}"
FACT = "nom_clean AS nom"
LABELLED_ROWS = f"""
SELECT {KEY}, * EXCLUDE (nom_clean, date, population_density, population_density_was_missing, label_next_7d_onset),
       population_density, CAST(population_density_was_missing AS BIGINT) AS population_density_was_missing,
       CAST(label_next_7d_onset AS BIGINT) AS label_next_7d_onset FROM labelled"""

ORACLES: dict[str, str] = {
    "drop_unattributed": _sql("SELECT * FROM raw_cases WHERE nom IS NOT NULL", "raw_cases"),
    "clean_zone_names": _sql(
        "SELECT r.nom, r.date, coalesce(a.canonical_nom, trim(r.nom)) AS nom_clean FROM raw_cases r "
        "LEFT JOIN aliases a ON trim(r.nom) = a.observed_name WHERE r.nom IS NOT NULL",
        "raw_cases", "aliases",
    ),
    "rejected_reports": _sql(
        """
SELECT reason, COUNT(*) AS n_rows FROM (
  SELECT CASE WHEN nom IS NULL THEN 'no name' WHEN TRY_CAST(cumulative_confirmed_cases AS DOUBLE) IS NULL THEN 'no number'
              WHEN date LIKE '%-17%' THEN 'no date' ELSE 'accepted' END AS reason FROM raw_cases) GROUP BY reason
UNION ALL SELECT 'accepted without date', 0""",
        "raw_cases",
    ),
    "coerce_counts": _sql(
        "SELECT nom, date, TRY_CAST(cumulative_confirmed_cases AS DOUBLE) AS cumulative_confirmed_cases FROM raw_cases",
        "raw_cases",
    ),
    "clean_dates": _sql(
        "SELECT nom, date AS date_text, CAST(CAST(replace(date, ']', '') AS DATE) AS VARCHAR) AS date FROM raw_cases",
        "raw_cases",
    ),
    "clean_cases": _sql(f"SELECT nom, {KEY}, cumulative_confirmed_cases FROM clean_cases", "clean_cases"),
    "clean_deaths": _sql(f"SELECT nom, {KEY}, cumulative_confirmed_deaths FROM clean_deaths", "clean_deaths"),
    "cleaning_report": _sql(
        """
SELECT * FROM (SELECT COUNT(*) AS case_rows, COUNT(*) - COUNT(r.nom) AS case_rows_without_zone,
       COUNT(DISTINCT r.nom) AS zone_names_raw,
       COUNT(*) FILTER (WHERE r.nom <> coalesce(a.canonical_nom, trim(r.nom))) AS names_changed,
       COUNT(DISTINCT coalesce(a.canonical_nom, trim(r.nom))) AS zone_names_clean,
       COUNT(*) FILTER (WHERE r.nom IS NOT NULL AND TRY_CAST(cumulative_confirmed_cases AS DOUBLE) IS NULL) AS case_counts_missing,
       COUNT(*) FILTER (WHERE r.nom IS NOT NULL AND TRY_CAST(cumulative_confirmed_cases AS DOUBLE) IS NOT NULL
                        AND r.date LIKE '%]') AS case_dates_cleaned
      FROM raw_cases r LEFT JOIN aliases a ON trim(r.nom) = a.observed_name),
     (SELECT COUNT(*) AS death_rows, COUNT(*) - COUNT(nom) AS death_rows_without_zone,
             COUNT(*) FILTER (WHERE nom IS NOT NULL AND TRY_CAST(cumulative_confirmed_deaths AS DOUBLE) IS NULL) AS death_counts_missing,
             COUNT(*) FILTER (WHERE nom IS NOT NULL AND date LIKE '%]') AS death_dates_cleaned FROM raw_deaths),
     (SELECT COUNT(DISTINCT nom) AS official_zones FROM health_zones),
     (SELECT COUNT(DISTINCT nom_clean) AS unmatched_zones FROM clean_cases WHERE nom_clean NOT IN (SELECT nom FROM health_zones))""",
        "raw_cases", "raw_deaths", "aliases", "health_zones", "clean_cases",
    ),
    "unmatched_zones": _sql(
        "SELECT DISTINCT nom_clean FROM clean_cases WHERE nom_clean NOT IN (SELECT nom FROM health_zones)",
        "clean_cases", "health_zones",
    ),
    "unmatched_preview": _sql(
        "SELECT nom_clean FROM (SELECT nom_clean FROM clean_cases EXCEPT SELECT nom FROM health_zones) ORDER BY 1 LIMIT 10",
        "clean_cases", "health_zones",
    ),
    "duplicate_reports": _sql(
        f"SELECT {KEY}, COUNT(*) AS n_rows FROM (SELECT nom_clean, date FROM clean_cases UNION ALL "
        "SELECT nom_clean, date FROM clean_deaths) GROUP BY nom_clean, date HAVING COUNT(*) > 1",
        "clean_cases", "clean_deaths",
    ),
    "distinct_zones": _sql("SELECT DISTINCT nom_clean FROM clean_cases", "clean_cases"),
    "new_cases": _sql(f"SELECT {KEY}, cumulative_confirmed_cases, new_cases FROM daily", "daily"),
    "rolling_7_sum": _sql(f"SELECT {KEY}, cumulative_confirmed_cases, rolling_7 FROM weekly", "weekly"),
    "rt_proxy": _sql(f"SELECT {KEY}, cumulative_confirmed_cases, new_cases, rt_proxy FROM series", "series"),
    "reported_growth": _sql(f"SELECT {KEY}, rt_proxy FROM series WHERE rt_proxy IS NOT NULL", "series"),
    "rolling_3_mean": _sql(f"SELECT {KEY}, day_idx, zone_rows, rolling_3d_new_cases FROM inputs", "inputs"),
    "trend_features": _sql(
        f"SELECT {KEY}, days_since_first_case, rolling_7d_new_cases, days_since_last_case FROM trend", "trend"
    ),
    "label_next_7d": _sql(
        f"SELECT {KEY}, CAST(label_next_7d_onset AS BIGINT) AS label_next_7d_onset, has_full_future_window FROM outlook",
        "outlook",
    ),
    "full_window_rows": _sql(
        """
SELECT COUNT(*) FILTER (WHERE has_full_future_window) AS kept, COUNT(*) FILTER (WHERE NOT has_full_future_window) AS dropped,
       avg(label_next_7d_onset) FILTER (WHERE has_full_future_window) AS positive_share FROM outlook""",
        "outlook",
    ),
    "labelled_features": _sql(LABELLED_ROWS, "labelled"),
    "date_cutoff_split": _sql(
        "SELECT is_train, COUNT(*) AS n, CAST(MIN(date) AS VARCHAR) AS first_date, CAST(MAX(date) AS VARCHAR) AS last_date "
        "FROM split GROUP BY is_train",
        "split",
    ),
    "trending_up": _sql(
        "SELECT COUNT(DISTINCT nom_clean) FILTER (WHERE rt_proxy > 1) AS zones_trending_up FROM series "
        "WHERE date = (SELECT MAX(date) FROM series)",
        "series",
    ),
    "serving_trend": _sql(
        """
SELECT z.nom, coalesce(t.r, 0) AS rolling_7d_new_cases, coalesce(t.d, 0) AS days_since_last_case,
       coalesce(t.rt, (SELECT quantile_disc(rt_proxy, 0.5 ORDER BY rt_proxy DESC) FROM series), 1) AS rt_proxy
FROM health_zones z LEFT JOIN (SELECT nom_clean, arg_max(rolling_7, date) AS r, arg_max_null(rt_proxy, date) AS rt,
       MAX(date) - coalesce(MAX(date) FILTER (WHERE new_cases > 0), MIN(date)) AS d FROM series GROUP BY 1) t ON z.nom = t.nom_clean""",
        "health_zones", "series",
    ),
    "national_outer_join": _sql(f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM national", "national"),
    "epidemic_curve": _sql(f"SELECT {ISO}, national_cumulative_confirmed_cases FROM national", "national"),
    "cfr_trend": _sql(
        f"SELECT {ISO}, CASE WHEN national_cumulative_confirmed_cases <> 0 THEN "
        "national_cumulative_confirmed_deaths / national_cumulative_confirmed_cases * 100 END AS cfr FROM national",
        "national",
    ),
    "cases_deaths_left_join": _sql(
        f"""SELECT s.nom_clean AS nom, CAST(s.date AS VARCHAR) AS date, s.cumulative_confirmed_cases, s.new_cases, s.rt_proxy,
       d.cumulative_confirmed_deaths FROM series s LEFT JOIN clean_deaths d ON s.nom_clean = d.nom_clean AND s.date = d.date""",
        "series", "clean_deaths",
    ),
    "density_impute": _sql(
        f"SELECT {KEY}, population_density, CAST(population_density_was_missing AS BIGINT) AS population_density_was_missing FROM density",
        "density",
    ),
    "star_latest_top10": _sql(
        f"""
SELECT z.nom, province, population_density, healthsite_density, {ISO}, cumulative_confirmed_cases, new_cases, rt_proxy, round(s.anomaly_score, 6) AS anomaly_score
FROM scores s JOIN health_zones z ON s.nom_clean = z.nom WHERE s.date = (SELECT MAX(date) FROM scores)
ORDER BY s.anomaly_score DESC, z.nom LIMIT 10""",
        "scores", "health_zones",
    ),
    "watchlist_history": _sql(
        f"""
SELECT z.nom, province, CAST(s.date AS VARCHAR) AS date, new_cases, rt_proxy, round(s.anomaly_score, 6) AS anomaly_score
FROM scores s JOIN health_zones z ON s.nom_clean = z.nom WHERE province IN ('ASIA', 'EUROPE')
ORDER BY s.date DESC, s.anomaly_score DESC, z.nom LIMIT 10""",
        "scores", "health_zones",
    ),
    "usable_zones": _sql(
        f"SELECT {KEY}, day_idx, day_idx < 14 AS is_baseline FROM inputs WHERE nom_clean IN "
        "(SELECT nom_clean FROM inputs GROUP BY 1 HAVING COUNT(*) >= 21)",
        "inputs",
    ),
    "selection_summary": _sql(
        """
SELECT COUNT(DISTINCT nom_clean) FILTER (WHERE n >= 21) AS zones_kept, COUNT(DISTINCT nom_clean) FILTER (WHERE n < 21) AS zones_dropped,
       CAST(SUM(CASE WHEN n >= 21 THEN least(n, 14) ELSE 0 END) AS BIGINT) AS baseline_rows,
       CAST(SUM(CASE WHEN n >= 21 THEN n ELSE 0 END) AS BIGINT) AS scored_rows
FROM (SELECT nom_clean, COUNT(*) AS n FROM clean_cases GROUP BY nom_clean)""",
        "clean_cases",
    ),
    "latest_per_zone": _sql(
        f"SELECT {FACT}, {ISO}, cumulative_confirmed_cases FROM series s WHERE date = "
        "(SELECT MAX(date) FROM series l WHERE l.nom_clean = s.nom_clean)",
        "series",
    ),
    "zone_state": _sql(
        """
SELECT z.nom, province, population_density, t.nom_clean IS NOT NULL AS has_case_data, coalesce(t.c, 0) AS cumulative_confirmed_cases,
       coalesce(t.age, 0) AS days_since_first_case, province IN ('ASIA', 'EUROPE') AS cross_border_watch
FROM health_zones z LEFT JOIN (SELECT nom_clean, arg_max(cumulative_confirmed_cases, date) AS c, MAX(date) - MIN(date) AS age
                               FROM series GROUP BY 1) t ON z.nom = t.nom_clean""",
        "health_zones", "series",
    ),
    "zone_history": _sql(
        f"SELECT {FACT}, {ISO}, cumulative_confirmed_cases, new_cases, rt_proxy FROM series WHERE nom_clean = 'Zone_7'", "series"
    ),
    "manifest_anti_join": "SELECT 'DON' || CAST(page_id AS VARCHAR) AS name, url FROM pages WHERE url NOT LIKE 'http://%'",
    "report_batches_union": _sql(
        "SELECT nom, date, cumulative_confirmed_cases AS number, 'cases' AS type FROM raw_cases UNION ALL "
        "SELECT nom, date, cumulative_confirmed_deaths, 'deaths' FROM raw_deaths",
        "raw_cases", "raw_deaths",
    ),
    "twice_series": _sql(
        f"SELECT {KEY}, zone_row, cumulative_confirmed_cases, new_cases, rolling_7, rt_proxy FROM twice_series", "twice_series"
    ),
    "twice_latest_per_zone": _sql(
        f"SELECT {FACT}, {ISO}, cumulative_confirmed_cases FROM twice_series s WHERE date = "
        "(SELECT MAX(date) FROM twice_series l WHERE l.nom_clean = s.nom_clean)",
        "twice_series",
    ),
    "twice_zone_state": _sql(
        """
SELECT z.nom, province, population_density, t.nom_clean IS NOT NULL AS has_case_data, coalesce(t.c, 0) AS cumulative_confirmed_cases,
       coalesce(t.age, 0) AS days_since_first_case
FROM health_zones z LEFT JOIN (SELECT nom_clean, arg_max(cumulative_confirmed_cases, zone_row) AS c, MAX(date) - MIN(date) AS age
                               FROM twice_series GROUP BY 1) t ON z.nom = t.nom_clean""",
        "health_zones", "twice_series",
    ),
    "twice_serving_trend": _sql(
        """
SELECT nom_clean, arg_max(rolling_7, zone_row) AS rolling_7d_new_cases,
       MAX(date) - coalesce(MAX(date) FILTER (WHERE new_cases > 0), MIN(date)) AS days_since_last_case,
       coalesce(arg_max_null(rt_proxy, zone_row), 1) AS rt_proxy
FROM twice_series GROUP BY 1""",
        "twice_series",
    ),
    "twice_cases_deaths": _sql(
        f"""SELECT s.nom_clean AS nom, CAST(s.date AS VARCHAR) AS date, s.cumulative_confirmed_cases, s.new_cases, s.rt_proxy,
       d.cumulative_confirmed_deaths FROM twice_series s LEFT JOIN twice_deaths d ON s.nom_clean = d.nom_clean AND s.date = d.date""",
        "twice_series", "twice_deaths",
    ),
    "zone_counts": _sql("SELECT nom_clean, COUNT(*) AS n_rows FROM clean_cases GROUP BY 1", "clean_cases"),
    "table_summary": _sql(
        "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT nom_clean) AS zones, CAST(MIN(date) AS VARCHAR) AS first_date, "
        "CAST(MAX(date) AS VARCHAR) AS last_date FROM clean_cases",
        "clean_cases",
    ),
    "class_balance": _sql(
        """
SELECT avg(label_next_7d_onset) AS overall, avg(label_next_7d_onset) FILTER (WHERE is_train) AS train,
       avg(label_next_7d_onset) FILTER (WHERE NOT is_train) AS test, COUNT(*) FILTER (WHERE is_train) AS train_rows,
       COUNT(*) FILTER (WHERE NOT is_train) AS test_rows FROM split""",
        "split",
    ),
    "median_density": _sql("SELECT round(median(known), 6) AS median_density FROM density", "density"),
    "upper_median_rt": _sql("SELECT quantile_disc(rt_proxy, 0.5 ORDER BY rt_proxy DESC) AS upper_median FROM series", "series"),
    "impute_growth": _sql(
        f"SELECT {KEY}, is_train, round(coalesce(rt_proxy, (SELECT median(rt_proxy) FROM split WHERE is_train)), 9) AS rt_proxy FROM split",
        "split",
    ),
    "longest_zone": _sql(
        "SELECT nom_clean, COUNT(*) AS n_rows FROM clean_cases GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1", "clean_cases"
    ),
    "top15_zones": _sql(
        "SELECT nom_clean, cumulative_confirmed_cases FROM clean_cases WHERE date = (SELECT MAX(date) FROM clean_cases) "
        "ORDER BY 2 DESC, 1 LIMIT 15",
        "clean_cases",
    ),
    "early_warning": _sql("SELECT * EXCLUDE (exact) FROM top200 WHERE rank <= 20", "top200"),
    "early_warning_cross_border": _sql(
        "SELECT * FROM (SELECT * EXCLUDE (exact), row_number() OVER (ORDER BY exact DESC, zone) AS rank FROM ranked "
        "WHERE cross_border_watch) WHERE rank <= 200",
        "ranked",
    ),
    "early_warning_header": _sql("SELECT MAX(date) AS generated_from_date, COUNT(*) AS zone_count FROM top200", "top200"),
    "ranking_page": _sql(
        """
SELECT rank AS row, zone, cross_border_watch, anomaly_score,
       CASE WHEN m > 0 THEN least(anomaly_score / m * 100, 100) ELSE 0 END AS bar_percent,
       CASE WHEN least(anomaly_score / m, 1) > 0.66 THEN 'hot' WHEN least(anomaly_score / m, 1) > 0.33 THEN 'warm' ELSE 'cool' END AS tier
FROM (SELECT *, greatest((SELECT MAX(anomaly_score) FROM top200), 0.0001) AS m FROM top200) WHERE rank <= 15""",
        "top200",
    ),
    "ranking_page_cross_border": _sql(
        """
SELECT row_number() OVER (ORDER BY rank) AS row, zone, cross_border_watch, anomaly_score,
       CASE WHEN m > 0 THEN least(anomaly_score / m * 100, 100) ELSE 0 END AS bar_percent,
       CASE WHEN least(anomaly_score / m, 1) > 0.66 THEN 'hot' WHEN least(anomaly_score / m, 1) > 0.33 THEN 'warm' ELSE 'cool' END AS tier
FROM (SELECT *, greatest((SELECT MAX(anomaly_score) FROM top200), 0.0001) AS m FROM top200) WHERE cross_border_watch
ORDER BY rank LIMIT 15""",
        "top200",
    ),
    "watchlist_chips": _sql(
        """
SELECT zone, province, rank, anomaly_score,
       CASE WHEN least(anomaly_score / m, 1) > 0.66 THEN 'hot' WHEN least(anomaly_score / m, 1) > 0.33 THEN 'warm' ELSE 'cool' END AS tier
FROM (SELECT *, greatest((SELECT MAX(anomaly_score) FROM top200), 0.0001) AS m FROM top200) WHERE cross_border_watch""",
        "top200",
    ),
    "zone_timeline": _sql(
        f"""
SELECT {KEY}, new_cases, round(anomaly_score, 6) AS anomaly_score, CAST(MAX(date) FILTER (WHERE day_idx = 14) OVER () AS VARCHAR) AS baseline_ends FROM scores
WHERE nom_clean = (SELECT nom_clean FROM scores GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)""",
        "scores",
    ),
    "evaluation_rows": _sql(
        f"SELECT {KEY}, round(anomaly_score, 6) AS anomaly_score, CAST(true_surge AS BIGINT) AS true_surge, CAST(flagged AS BIGINT) AS flagged FROM evaluation",
        "evaluation",
    ),
    "confusion_matrix": _sql(
        "SELECT CAST(true_surge AS BIGINT) AS label, CAST(flagged AS BIGINT) AS prediction, COUNT(*) AS n FROM evaluation GROUP BY 1, 2",
        "evaluation",
    ),
    "classification_report": _sql(
        """,
cells AS (SELECT y, COUNT(*) FILTER (WHERE flagged = y AND true_surge = y) AS tp, COUNT(*) FILTER (WHERE flagged = y) AS predicted,
                 COUNT(*) FILTER (WHERE true_surge = y) AS support
          FROM evaluation, (VALUES (0), (1)) v(y) GROUP BY y),
pr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM cells),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr)
SELECT CASE y WHEN 0 THEN 'no new case' ELSE 'new case' END AS class, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, support FROM f
UNION ALL SELECT 'accuracy', round(SUM(tp) / SUM(support), 9), round(SUM(tp) / SUM(support), 9), round(SUM(tp) / SUM(support), 9),
       CAST(SUM(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(SUM(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(SUM(precision * support) / SUM(support), 9), round(SUM(recall * support) / SUM(support), 9),
       round(SUM(f1 * support) / SUM(support), 9), CAST(SUM(support) AS BIGINT) FROM f""",
        "evaluation",
    ),
    "pr_curve": _sql(
        "SELECT round(threshold, 6) AS threshold, tp / flagged_rows AS precision, CASE WHEN all_pos > 0 THEN tp / all_pos ELSE 1 END AS recall FROM curve "
        "UNION ALL SELECT NULL, 1, 0",
        "curve",
    ),
    "average_precision": _sql(
        "SELECT round(SUM(pos / all_pos * tp / flagged_rows), 9) AS average_precision FROM curve", "curve"
    ),
    "surge_evaluation": _sql(
        """
SELECT COUNT(*) AS evaluated_rows, CAST(SUM(true_surge) AS BIGINT) AS surges, round(avg(true_surge), 9) AS base_rate,
       (SELECT round(SUM(pos / all_pos * tp / flagged_rows), 9) FROM curve) AS average_precision FROM evaluation""",
        "evaluation", "curve",
    ),
    "html_page_forms": _sql(
        """
SELECT page_id, CASE page_id % 4 WHEN 1 THEN b.article WHEN 3 THEN '“x” © 2020' || chr(10) || a.article ELSE a.article END AS article
FROM page_text a JOIN body_text b USING (page_id)""",
        "page_text", "body_text",
    ),
    "html_article_text": _sql("SELECT page_id, article FROM page_text", "page_text"),
    "article_lengths": _sql("SELECT page_id, length(article) AS n_chars FROM page_text", "page_text"),
    "count_mentions": _sql("SELECT bulletin, pos, value, type FROM mentions", "mentions"),
    "mention_context": _sql("SELECT bulletin, pos, context FROM mentions", "mentions"),
    "max_counts": _sql("SELECT type, MAX(value) AS largest, COUNT(*) AS mentions FROM mentions GROUP BY type", "mentions"),
    "largest_mention": _sql(
        "SELECT b.bulletin, value, type, context FROM bulletins b LEFT JOIN (SELECT *, row_number() OVER "
        "(PARTITION BY bulletin ORDER BY value DESC NULLS LAST, pos) AS rn FROM mentions) m ON b.bulletin = m.bulletin AND rn = 1",
        "bulletins", "mentions",
    ),
    "paragraphs": _sql("SELECT bulletin, pos, paragraph FROM paras", "paras"),
    "truncate_ellipsis": _sql(
        "SELECT bulletin, pos, CASE WHEN length(paragraph) > 150 THEN left(paragraph, 150) || '...' ELSE paragraph END AS preview FROM paras",
        "paras",
    ),
    "severity_labels": _sql("SELECT bulletin, pos, label, confidence FROM judged", "judged"),
    "severity_step": _sql(
        SEVERITY_SEEDS + _severity_step("step0", "step1")
        + " SELECT bulletin, pos, round_even(s0, 6) AS s0, round_even(s1, 6) AS s1, round_even(s2, 6) AS s2 FROM step1",
        "paras",
    ),
    "severity_refined": _sql(
        SEVERITY_SEEDS + ",".join(_severity_step(f"step{n}", f"step{n + 1}") for n in range(3))
        + """
SELECT bulletin, pos, CASE WHEN s2 = greatest(s0, s1, s2) THEN 'emergency-level crisis' WHEN s1 = greatest(s0, s1, s2) THEN 'concerning escalation'
                           ELSE 'routine update' END AS label, round(greatest(s0, s1, s2), 3) AS confidence FROM step3""",
        "paras",
    ),
    "most_severe_paragraph": _sql(
        "SELECT b.bulletin, w.paragraph, w.label, w.confidence FROM bulletins b LEFT JOIN worst w USING (bulletin)",
        "bulletins", "worst",
    ),
    "gazetteer_locations": _sql("SELECT bulletin, array_to_string(names, '|') AS locations FROM places", "places"),
    "gazetteer_locations_filtered": _sql("SELECT bulletin, array_to_string(names, '|') AS locations FROM places", "places"),
    "bulletin_headlines": _sql("SELECT * FROM headlines", "headlines"),
    "bulletin_briefing": _sql(
        """
SELECT h.bulletin, (SELECT array_to_string(names, '|') FROM places p WHERE p.bulletin = h.bulletin) AS locations,
       (SELECT COUNT(*) FROM mentions m WHERE m.bulletin = h.bulletin) AS mentions,
       (SELECT COUNT(*) FROM paras q WHERE q.bulletin = h.bulletin) AS paragraphs,
       label, confidence, paragraph, (SELECT COUNT(*) FROM bulletins) AS bulletin_count
FROM headlines h WHERE h.bulletin = (SELECT MAX(bulletin) FROM bulletins)""",
        "headlines", "paras",
    ),
    "bulletin_id_parts": _sql(
        "SELECT bulletin, split_part(bulletin, '_', 1) AS number, split_part(bulletin, '_', 2) AS published FROM bulletins",
        "bulletins",
    ),
    "json_props": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "score_tiers": _sql(
        """
SELECT nom, anomaly_score,
       CASE WHEN least(anomaly_score / m, 1) > 0.66 THEN 'hot' WHEN least(anomaly_score / m, 1) > 0.33 THEN 'warm' ELSE 'cool' END AS tier,
       round(least(anomaly_score / m * 100, 100), 6) AS bar_percent
FROM (SELECT *, greatest(MAX(anomaly_score) OVER (), 0.0001) AS m
      FROM (SELECT nom, round(anomaly_score, 6) AS anomaly_score FROM latest_scores))""",
        "latest_scores",
    ),
    "log_features": _sql(
        f"SELECT {KEY}, round(ln(1 + cumulative_confirmed_cases), 9) AS cumulative_log, round(ln(1 + rolling_7), 9) AS rolling_7_log FROM weekly",
        "weekly",
    ),
    "anomaly_scores": _sql(f"SELECT {KEY}, round(anomaly_score, 6) AS anomaly_score FROM scores", "scores"),
    "anomaly_scores_cascade": _sql(f"SELECT {KEY}, round(anomaly_score, 6) AS anomaly_score FROM scores", "scores"),
    "forest_walk": _sql("SELECT COUNT(*) FILTER (WHERE NOT is_train) AS n_rows, 0::BIGINT AS differing FROM split", "split"),
    "forest_importances": (
        "SELECT unnest(['cumulative_confirmed_cases', 'days_since_first_case', 'population_density']) AS feature, true AS same, true AS adds_up"
    ),
    "network_training": _sql(
        "SELECT COUNT(*) FILTER (WHERE NOT is_train) AS n_rows, 0::BIGINT AS changed_by_rerun, 0::BIGINT AS changed_by_storing, "
        "0::BIGINT AS out_of_range, true AS loss_fell, true AS ended_by_rule FROM split",
        "split",
    ),
    "network_agreement": _sql("SELECT COUNT(*) FILTER (WHERE NOT is_train) AS n_rows, 0::BIGINT AS differing FROM split", "split"),
    "zone_prediction_records": _sql(
        """
SELECT z.nom, province, population_density, t.nom_clean IS NOT NULL AS has_case_data, coalesce(t.c, 0) AS cumulative_confirmed_cases,
       coalesce(t.age, 0) AS days_since_first_case, province IN ('ASIA', 'EUROPE') AS cross_border_watch,
       true AS network_valid, true AS forest_valid
FROM health_zones z LEFT JOIN (SELECT nom_clean, arg_max(cumulative_confirmed_cases, date) AS c, MAX(date) - MIN(date) AS age
                               FROM series GROUP BY 1) t ON z.nom = t.nom_clean""",
        "health_zones", "series",
    ),
    "zone_probability_agreement": _sql(
        "SELECT COUNT(*) AS zones, 0::BIGINT AS network_differs, 0::BIGINT AS forest_differs FROM health_zones", "health_zones"
    ),
    "standardise_train_stats": _sql(
        "SELECT "
        + ", ".join(
            f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_sd"
            for c in ("cumulative_confirmed_cases", "days_since_first_case", "population_density")
        )
        + " FROM split WHERE is_train",
        "split",
    ),
    "standardised_features": _sql(
        f"SELECT {KEY}, "
        + ", ".join(
            f"round(({c} - (SELECT avg({c}) FROM split WHERE is_train)) / (SELECT stddev_pop({c}) FROM split WHERE is_train), 6) AS {c}_std"
            for c in ("cumulative_confirmed_cases", "days_since_first_case", "population_density")
        )
        + " FROM split",
        "split",
    ),
    "missing_features": _sql(
        "SELECT "
        + ", ".join(
            f"COUNT(*) - COUNT({c}) AS {c}"
            for c in ("cumulative_confirmed_cases", "days_since_first_case", "population_density")
        )
        + " FROM labelled",
        "labelled",
    ),
    "balanced_weights": _sql(
        "SELECT CAST(label_next_7d_onset AS BIGINT) AS label_next_7d_onset, COUNT(*) AS class_rows, "
        "(SELECT COUNT(*) FROM split WHERE is_train) / (2 * COUNT(*)) AS weight FROM split WHERE is_train GROUP BY 1",
        "split",
    ),
    "network_class_copies": _sql(
        "SELECT CAST(label_next_7d_onset AS BIGINT) AS label_next_7d_onset, MAX(COUNT(*)) OVER () AS copies "
        "FROM split WHERE is_train GROUP BY 1",
        "split",
    ),
    "loss_weight": _sql(
        """
SELECT COUNT(*) FILTER (WHERE label_next_7d_onset = 1) AS n_pos, COUNT(*) FILTER (WHERE label_next_7d_onset = 0) AS n_neg,
       COUNT(*) FILTER (WHERE label_next_7d_onset = 0) / greatest(COUNT(*) FILTER (WHERE label_next_7d_onset = 1), 1) AS positive_weight
FROM split WHERE is_train""",
        "split",
    ),
    "roundtrip_parquet": _sql(
        f"SELECT {KEY}, cumulative_confirmed_cases, new_cases, rolling_7, rt_proxy FROM series", "series"
    ),
    "roundtrip_partitioned": _sql(LABELLED_ROWS, "labelled"),
    "roundtrip_csv": _sql("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM national", "national"),
    "csv_national": _sql(
        f"SELECT {ISO}, national_cumulative_confirmed_cases, national_cumulative_confirmed_deaths, CASE WHEN "
        "national_cumulative_confirmed_cases <> 0 THEN national_cumulative_confirmed_deaths / "
        "national_cumulative_confirmed_cases * 100 END AS cfr FROM national",
        "national",
    ),
    "csv_reports": _sql(f"SELECT nom, {KEY}, cumulative_confirmed_cases FROM clean_cases", "clean_cases"),
    "csv_death_reports": _sql(f"SELECT nom, {KEY}, cumulative_confirmed_deaths FROM clean_deaths", "clean_deaths"),
    "geojson_zones": _sql("SELECT * FROM health_zones", "health_zones"),
    "appended_articles": _sql(
        "SELECT 'DON' || CAST(page_id AS VARCHAR) AS name, length(article) AS n_chars FROM page_text", "page_text"
    ),
    "star_versions": _sql(
        """
SELECT 'health_zones' AS table_name, COUNT(*) AS n_rows, true AS replacement_failed FROM health_zones
UNION ALL SELECT 'daily_cases', COUNT(*), true FROM series UNION ALL SELECT 'anomaly_scores', COUNT(*), true FROM scores""",
        "health_zones", "series", "scores",
    ),
    "bulletin_files": _sql(
        """
SELECT b.bulletin, length(text) + 1 AS n_chars, coalesce(n, 0) AS n_paragraphs
FROM bulletins b LEFT JOIN (SELECT bulletin, COUNT(*) AS n FROM paras GROUP BY 1) p ON b.bulletin = p.bulletin""",
        "bulletins", "paras",
    ),
    "manifest_entries": """
SELECT 'DON' || page_id::VARCHAR || '_' || CAST(DATE '2026-01-01' + CAST(page_id % 300 AS INT) AS VARCHAR) AS name,
       'DON' || page_id::VARCHAR AS number, CAST(DATE '2026-01-01' + CAST(page_id % 300 AS INT) AS VARCHAR) AS published,
       NOT url LIKE 'http://%' AS is_new FROM pages""",
    "bulletin_file_stems": _sql("SELECT bulletin, bulletin AS stem FROM bulletins", "bulletins"),
    "stored_probabilities": _sql(
        f"SELECT {KEY}, round_even(days_since_first_case * 7919 % 1000 / 1000, 2) AS shown, "
        "CAST(days_since_first_case * 7919 % 1000 >= 500 AS BIGINT) AS predicted FROM labelled",
        "labelled",
    ),
    "stored_probabilities_confusion": _sql(
        "SELECT CAST(label_next_7d_onset AS BIGINT) AS label, CAST(days_since_first_case * 7919 % 1000 >= 500 AS BIGINT) AS prediction, "
        "COUNT(*) AS n FROM labelled GROUP BY 1, 2",
        "labelled",
    ),
    "reloaded_models": _sql(
        "SELECT model, COUNT(*) FILTER (WHERE NOT is_train) AS n_rows, 0::BIGINT AS changed "
        "FROM split, (VALUES ('forest'), ('network')) v(model) GROUP BY model",
        "split",
    ),
    "roundtrip_json": _sql(
        """
SELECT bulletin, 'count' AS part, pos, type AS name, CAST(value AS DOUBLE) AS number, context AS body FROM mentions
UNION ALL SELECT bulletin, 'place', i - 1, names[i], NULL, NULL
FROM (SELECT bulletin, names, unnest(generate_series(1, len(names))) AS i FROM places)
UNION ALL SELECT bulletin, 'paragraph', pos, label, confidence,
       CASE WHEN length(paragraph) > 150 THEN left(paragraph, 150) || '...' ELSE paragraph END FROM judged""",
        "mentions", "places", "judged",
    ),
    "star_tables_sql": _sql(
        """
SELECT province, COUNT(*) AS zone_days, COUNT(DISTINCT z.nom) AS zones, round(MAX(anomaly_score), 6) AS max_score
FROM scores s JOIN health_zones z ON s.nom_clean = z.nom GROUP BY province""",
        "scores", "health_zones",
    ),
}
