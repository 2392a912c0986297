"""What DuckDB expects of the queries that SQL can express."""

#: Levels of a tree that the SQL below builds: enough for 16 million leaves a source and as many sources.
_LEVELS = 6


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _manifest() -> str:
    """Each level of the trees as a table, the siblings of every node, and then every leaf folded level by level."""
    plain = ["d.doc_id", "source", "lang", "n_chars"]
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    row, tampered = (" || ".join(map(_field, [*plain, text])) for text in ("text", lowered))
    tables = [
        """checksums AS (
  SELECT id, xor(4294967295, list_reduce(
           flatten(list_transform(string_split(CAST(id AS VARCHAR), ''),
                                  lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
           CAST(4294967295 AS BIGINT))) AS checksum
  FROM (SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL) AS ids)""",
        f"""leaves AS (
  SELECT coalesce(':' || source, '') AS tree, d.doc_id, sha256({row}) AS leaf,
         CASE WHEN checksum % 5 = 0 THEN sha256({tampered}) END AS changed
  FROM documents d LEFT JOIN checksums ON id = d.doc_id)""",
        """row0 AS (
  SELECT tree, doc_id, leaf, changed, leaf AS h, count(*) OVER (PARTITION BY tree) AS n,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)""",
    ]

    def upwards(kind: str) -> None:
        for k in range(_LEVELS):
            tables.append(f"""{kind}{k + 1} AS (
  SELECT tree, i // 16 AS i, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h,
         (n + 15) // 16 AS n FROM {kind}{k} GROUP BY tree, i // 16, n)""")
            tables.append(f"""{kind}_siblings{k} AS (
  SELECT x.tree, x.i, x.n > 1 AS is_run,
         coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS earlier,
         coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS later
  FROM {kind}{k} x JOIN {kind}{k} y ON x.tree = y.tree AND x.i // 16 = y.i // 16 GROUP BY x.tree, x.i, x.n)""")

    def folds(kind: str, start: str) -> None:
        for k in range(_LEVELS):
            below = start if k == 0 else f"{kind}_fold{k - 1}"
            tables.append(f"""{kind}_fold{k} AS (
  SELECT f.* REPLACE (CASE WHEN is_run THEN sha256(earlier || x || later) ELSE x END AS x,
                      proof || earlier || later AS proof, {kind}_at // 16 AS {kind}_at)
  FROM {below} f JOIN {kind}_siblings{k} s ON s.tree = {kind}_tree AND s.i = {kind}_at)""")

    upwards("row")
    tables.append(f"""source0 AS (
  SELECT '' AS tree, tree AS source, h, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS i
  FROM row{_LEVELS})""")
    upwards("source")
    tables.append("""folding AS (
  SELECT row0.doc_id, row0.leaf, coalesce(row0.changed, row0.leaf) AS x, '' AS proof, row0.tree AS row_tree,
         row0.i AS row_at, '' AS source_tree, source0.i AS source_at, source0.h AS subroot
  FROM row0 JOIN source0 ON source0.source = row0.tree)""")
    folds("row", "folding")
    folds("source", f"row_fold{_LEVELS - 1}")
    return "WITH " + ",\n".join(tables) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, x AS folded_root, x = root AS verified
FROM source_fold{_LEVELS - 1} CROSS JOIN (SELECT h AS root FROM source{_LEVELS}) AS top"""


ORACLE: dict[str, str] = {
    "op11_manifest": _manifest(),
    "op6_url_filter": r"""
WITH RECURSIVE parts AS (
  SELECT page_id, html,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
         coalesce(regexp_extract(url, '^.*?://[^?#]*(\?[^#]*)', 1, 's'), '') AS query
  FROM pages
),
pages_of AS (
  SELECT *, CASE WHEN host <> '' THEN concat(host, CASE WHEN path = '' THEN '/' ELSE path END, query) END AS node
  FROM parts
),
tags AS (
  SELECT node, host, path, unnest(regexp_extract_all(html, '<(?:link|meta)\b[^>]*>', 0, 'is')) AS tag
  FROM pages_of WHERE node IS NOT NULL
),
links AS (
  SELECT node, host, path,
         trim(coalesce(nullif(regexp_extract(tag, '\bhref\s*=\s*["'']?([^"''\s>]+)', 1, 'is'), ''),
                       regexp_extract(tag, 'url\s*=\s*["'']?([^"''\s>]+)', 1, 'is'))) AS link
  FROM tags
  WHERE regexp_matches(tag, '\brel\s*=\s*["'']?canonical\b', 'is')
     OR regexp_matches(tag, 'http-equiv\s*=\s*["'']?refresh', 'is')
),
targets AS (
  SELECT node,
         CASE WHEN contains(link, '://') THEN link
              WHEN starts_with(link, '//') THEN concat('http:', link)
              WHEN starts_with(link, '/') THEN concat('http://', host, link)
              WHEN starts_with(link, '?') THEN concat('http://', host, path, link)
              ELSE concat('http://', host, coalesce(nullif(regexp_extract(path, '^(.*/)', 1, 's'), ''), '/'), link)
         END AS url
  FROM links WHERE link <> ''
),
ends AS (
  SELECT node,
         translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
         regexp_extract(url, '^.*?://[^?#]*(\?[^#]*)', 1, 's') AS query
  FROM targets
),
edges AS (
  SELECT node AS a, concat(host, CASE WHEN path = '' THEN '/' ELSE path END, query) AS b FROM ends WHERE host <> ''
),
ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reached AS (
  SELECT a AS node, a AS other FROM ways
  UNION
  SELECT r.node, w.b FROM reached r JOIN ways w ON r.other = w.a
),
places AS (
  SELECT DISTINCT host, path FROM parts
  UNION
  SELECT DISTINCT regexp_extract(other, '^([^/]*)', 1, 's'), regexp_extract(other, '^[^/]*([^?]*)', 1, 's') FROM reached
),
rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
ruled AS (
  SELECT p.host, p.path, max_by(concat(r.host, r.path), length(concat(r.host, r.path))) AS rule,
         max_by(r.verdict, length(concat(r.host, r.path))) AS ruling
  FROM places p
  JOIN rules r ON (p.host = r.host OR ends_with(p.host, concat('.', r.host))) AND starts_with(p.path, r.path)
  GROUP BY p.host, p.path
),
aliases AS (
  SELECT r.node, max(CASE WHEN u.ruling = 'block' THEN 1 ELSE 0 END) AS blocked, count(*) - 1 AS n_aliases
  FROM reached r
  LEFT JOIN ruled u ON u.host = regexp_extract(r.other, '^([^/]*)', 1, 's')
                   AND u.path = regexp_extract(r.other, '^[^/]*([^?]*)', 1, 's')
  GROUP BY r.node
)
SELECT p.page_id, p.host, p.path, u.rule,
       coalesce(u.ruling, CASE WHEN a.blocked = 1 THEN 'block' END, 'allow') AS verdict,
       coalesce(a.n_aliases, 0) AS n_aliases
FROM pages_of p
LEFT JOIN ruled u ON u.host = p.host AND u.path = p.path
LEFT JOIN aliases a ON a.node = p.node
""",
}
