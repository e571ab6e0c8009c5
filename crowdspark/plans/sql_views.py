"""The views of ``tables`` as SQL, for the check against another engine."""

from __future__ import annotations

from collections.abc import Sequence

VIEWS: dict[str, str] = {}

VIEWS["v_inventory"] = """
SELECT 'EV' AS season, 'U' || user_id AS site, CAST(weekofyear(ts) AS VARCHAR) AS roll,
       'IMG' || event_id || '.JPG' AS image_name_original, date_trunc('second', ts) AS datetime,
       event_id, event_type, value, props,
       '/img/EV/U' || user_id || '/U' || user_id || '_R' || weekofyear(ts) || '/IMG' || event_id || '.JPG'
         AS image_path_original,
       'EV/U' || user_id || '/U' || user_id || '_R' || weekofyear(ts) || '/IMG' || event_id || '.JPG'
         AS image_path_original_rel
FROM events"""

VIEWS["v_annotations"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS subject_id, 'u' || l_suppkey AS user_name,
       l_orderkey || '-' || l_suppkey AS classification_id,
       CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'zebra' WHEN 'AO' THEN 'lion' WHEN 'NF' THEN 'giraffe'
         WHEN 'NO' THEN 'blank' WHEN 'RF' THEN 'human' ELSE 'buffalo' END AS question__species,
       CASE WHEN l_returnflag || l_linestatus = 'NO' THEN '' WHEN l_quantity > 40 THEN '51+'
         WHEN l_quantity > 10 THEN '11-50' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS question__count,
       CASE WHEN l_returnflag || l_linestatus = 'NO' OR l_tax = 0 THEN '' WHEN l_tax >= 0.04 THEN '1' ELSE '0' END
         AS question__standing,
       CASE WHEN l_returnflag || l_linestatus = 'NO' THEN '' WHEN l_discount >= 0.08 THEN '1' ELSE '0' END
         AS question__young_present,
       l_shipdate AS created_at, l_linenumber AS line_no, l_partkey AS part_no, l_extendedprice AS price,
       l_quantity AS quantity
FROM lineitem"""

# capture columns of v_inventory for a gap of six hours
VIEWS["v_gaps"] = """
SELECT *, row_number() OVER w AS image_rank_in_roll,
       coalesce(epoch(datetime) - epoch(lag(datetime) OVER w), 0.0) AS seconds_to_last_image_taken,
       coalesce(epoch(lead(datetime) OVER w) - epoch(datetime), 0.0) AS seconds_to_next_image_taken
FROM v_inventory WINDOW w AS (PARTITION BY season, site, roll ORDER BY datetime, image_path_original)"""

VIEWS["v_numbered"] = """
SELECT *, 1 + sum(CASE WHEN seconds_to_last_image_taken > 21600 THEN 1 ELSE 0 END) OVER (
         PARTITION BY season, site, roll ORDER BY image_rank_in_roll) AS capture
FROM v_gaps"""

VIEWS["v_captures"] = """
SELECT * EXCLUDE (capture, image_rank_in_roll),
       CAST(image_rank_in_roll AS INTEGER) AS image_rank_in_roll, CAST(capture AS INTEGER) AS capture,
       CAST(row_number() OVER (PARTITION BY season, site, roll, capture ORDER BY image_rank_in_roll) AS INTEGER)
         AS image_rank_in_capture,
       season || '#' || site || '#' || roll || '#' || CAST(capture AS INTEGER) AS capture_id,
       floor(seconds_to_last_image_taken / 864.0 + 0.5) / 100.0 AS days_to_last_image_taken,
       floor(seconds_to_next_image_taken / 864.0 + 0.5) / 100.0 AS days_to_next_image_taken,
       season || '_' || site || '_R' || roll || '_IMAG' || printf('%04d', image_rank_in_roll) || '.JPG' AS image_name
FROM v_numbered"""

# classification rows: the columns the export's JSON is built from, not the JSON
VIEWS["v_classifications"] = """
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INTEGER)
         AS classification_id,
       CASE WHEN l_suppkey % 10 = 0 THEN 'not-logged-in-' ELSE 'u' END || l_suppkey AS user_name,
       CASE WHEN l_suppkey % 10 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS user_id,
       CASE WHEN l_linenumber <= 5 THEN '10' ELSE '11' END AS workflow_id, 300 + l_partkey % 50 AS version,
       (300 + l_partkey % 50) || CASE WHEN l_linenumber = 1 THEN '' ELSE '.' || l_linenumber END AS workflow_version,
       CASE WHEN CAST(l_quantity AS INTEGER) = 1 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
         ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S UTC') END AS created_at,
       CASE WHEN CAST(l_quantity AS INTEGER) <> 1 THEN CAST(l_shipdate AS DATE) END AS day,
       l_tax <> 0 AS live, l_discount = 0.1 AS seen, CASE WHEN l_partkey % 7 = 0 THEN '' ELSE 'S' || (l_partkey % 2) END AS season,
       CAST(l_orderkey AS VARCHAR) AS subject_ids, l_extendedprice AS price, l_returnflag || l_linestatus AS kind,
       CASE WHEN CAST(l_quantity AS INTEGER) > 40 THEN '51+' WHEN CAST(l_quantity AS INTEGER) > 10 THEN '11-50'
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS how_many,
       CASE WHEN l_partkey % 2 = 0 THEN '1' ELSE '0' END AS eats, CASE WHEN l_tax >= 0.04 THEN '1' ELSE '0' END AS young
FROM lineitem"""

# the identifications of every classification row, repeated main answers already dropped
VIEWS["v_identified"] = """
SELECT v_classifications.*, identification_no, species, animals, young_present, eating, moving FROM v_classifications JOIN (
  SELECT 'AF' AS kind, 1 AS identification_no, 'zebra' AS species, NULL AS animals, NULL AS young_present, NULL AS eating, '1' AS moving
  UNION ALL SELECT 'AF', 2, 'lion', '', '', '', ''
  UNION ALL SELECT 'AO', 1, 'blank', '', '', '', '' UNION ALL SELECT 'AO', 2, 'lion', '', '', '', ''
  UNION ALL SELECT 'NF', 1, 'blank', '', '', '', ''
  UNION ALL SELECT 'RF', 1, 'giraffe', '', '', '', '' UNION ALL SELECT 'RF', 2, '1', '', '', '', ''
  UNION ALL SELECT 'RO', 1, 'giraffe', '', '', '', '') USING (kind)"""

VIEWS["v_extracted"] = """
SELECT * EXCLUDE (animals, young_present, eating), coalesce(animals, how_many) AS animals,
  coalesce(young_present, young) AS young_present, coalesce(eating, eats) AS eating FROM v_identified"""

REQUIRES = {
    "v_identified": ["v_classifications"],
    "v_extracted": ["v_identified"],
    "v_gaps": ["v_inventory"],
    "v_numbered": ["v_gaps"],
    "v_captures": ["v_numbered"],
}


def with_views(names: Sequence[str], sql: str) -> str:
    """The statement with the definitions of its views, and of the views they use, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for required in REQUIRES.get(name, []):
            add(required)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    if not parts:
        return sql.strip()
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"
