"""DuckDB statements of every registered query, for the value-hash oracle.

These are plain SQL over the driver's tables; they restate each operator's
definition independently of the Spark plan (window functions on one node,
recursive CTEs for the ordered algorithms). Column names and types match the
Spark results.
"""

from __future__ import annotations

# Fixture views shared by the statements below.
FX = {
    "fx_classes": """SELECT * FROM (VALUES ('person',0,1),('fire',1,1),('gun',2,1),('smoke',3,2),('knife',4,2),
        ('car',5,3),('dog',6,4),('cat',7,4)) AS t(name,id,priority_tier)""",
    "fx_items": """SELECT o_orderkey AS image_id,
        CASE o_custkey % 3 WHEN 0 THEN 'coco' WHEN 1 THEN 'weapons' ELSE 'fire_smoke' END AS source,
        row_number() OVER (PARTITION BY o_custkey % 3 ORDER BY o_orderkey) AS row_idx,
        (o_orderkey % 37) <> 0 AS valid
      FROM orders""",
    "fx_ann": "SELECT l_orderkey AS image_id, l_linenumber AS pos, CAST(l_partkey % 11 AS INT) AS category_id FROM lineitem",
    "fx_image_classes": """SELECT DISTINCT a.image_id, c.name AS class FROM fx_ann a JOIN fx_classes c ON c.id = a.category_id""",
    "fx_item_class": "SELECT i.*, ic.class FROM fx_items i JOIN fx_image_classes ic USING (image_id)",
    "fx_items_wc": """SELECT i.image_id, i.source, i.row_idx, i.valid, coalesce(c.classes, CAST([] AS VARCHAR[])) AS classes
      FROM fx_items i LEFT JOIN (SELECT image_id, list_sort(list(class)) AS classes FROM fx_image_classes GROUP BY image_id) c
      USING (image_id)""",
    "fx_measures": """SELECT o_orderkey AS image_id,
        CASE WHEN o_orderkey % 37 = 0 THEN 0 ELSE 200 + CAST(o_custkey % 900 AS INT) END AS width,
        CASE WHEN o_orderkey % 37 = 0 THEN 0 ELSE 200 + CAST((o_orderkey * 7) % 700 AS INT) END AS height,
        CASE WHEN o_orderkey % 37 = 0 THEN CAST(0 AS DOUBLE)
             ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 2600 AS DOUBLE) / CAST(10 AS DOUBLE) END AS brightness,
        CASE WHEN o_orderkey % 37 = 0 THEN CAST(0 AS DOUBLE)
             ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 4001 AS DOUBLE) / CAST(10 AS DOUBLE) END AS blur_score
      FROM orders""",
    "fx_boxes": """SELECT l.l_orderkey AS image_id, l.l_linenumber AS pos,
        CASE WHEN l.l_partkey % 11 < 8 THEN c.name ELSE 'unicorn' END AS class_name,
        l.l_quantity * 20 - 50 AS x_min, CAST(l.l_linenumber * 60 - 90 AS DOUBLE) AS y_min,
        l.l_quantity * 8 AS box_width, CAST(l.l_linenumber * 50 AS DOUBLE) AS box_height, m.width, m.height
      FROM lineitem l JOIN fx_measures m ON m.image_id = l.l_orderkey
      LEFT JOIN fx_classes c ON c.id = l.l_partkey % 11 WHERE m.width > 0""",
    "fx_yolo_lines": """SELECT l_orderkey AS image_id, l_linenumber AS pos,
        CASE WHEN l_linenumber = 7 THEN 'x 0.5 0.5 0.1 0.1' WHEN l_linenumber = 6 THEN '1.0 0.5 0.5 0.1 0.1'
             WHEN l_linenumber = 5 THEN '' ELSE concat(CAST(l_partkey % 11 AS VARCHAR), ' 0.5 0.5 0.1 0.1') END AS line
      FROM lineitem""",
    "fx_rows": """SELECT o.o_orderkey AS image_id,
        CASE o.o_custkey % 3 WHEN 0 THEN 'coco' WHEN 1 THEN 'weapons' ELSE 'fire_smoke' END AS source,
        CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(o.o_orderkey % 10 AS INT) END AS label,
        coalesce(a.cats, CAST([] AS INT[])) AS cats
      FROM orders o LEFT JOIN (SELECT image_id, list_sort(list(category_id)) AS cats FROM fx_ann GROUP BY image_id) a
      ON a.image_id = o.o_orderkey""",
    "fx_pixels": """SELECT vec_id AS image_id, CAST(pos // 8 AS INT) AS r, CAST(pos % 8 AS INT) AS c,
        CAST(floor((CAST(embedding[pos+1] AS DOUBLE) + CAST(0.6 AS DOUBLE)) * 200) AS INT) AS g
      FROM embeddings, (SELECT unnest(range(64)) AS pos)""",
    "fx_hash0": """SELECT image_id,
        CAST(sum(CASE WHEN r <  4 AND g > md THEN CAST(1 AS BIGINT) << (r * 8 + c) ELSE 0 END) AS BIGINT) AS hash_hi,
        CAST(sum(CASE WHEN r >= 4 AND g > md THEN CAST(1 AS BIGINT) << ((r - 4) * 8 + c) ELSE 0 END) AS BIGINT) AS hash_lo
      FROM (SELECT p.*, m.md FROM fx_pixels p JOIN (SELECT image_id, median(g) AS md FROM fx_pixels GROUP BY image_id) m
            ON m.image_id = p.image_id) t GROUP BY image_id""",
    "fx_hashes": """SELECT image_id, hash_hi, hash_lo FROM fx_hash0
      UNION ALL SELECT image_id + 1000000, hash_hi, xor(hash_lo, (CAST(1 AS BIGINT) << CAST(image_id % 9 AS INT)) - 1)
        FROM fx_hash0
      UNION ALL SELECT image_id + 2000000, hash_hi, xor(hash_lo, (CAST(1 AS BIGINT) << CAST(image_id % 9 + 4 AS INT)) - 1)
        FROM fx_hash0""",
}

# dependency order of the fixture views
_FX_ORDER = list(FX)


def with_fx(body: str, *names: str) -> str:
    """Prefix ``body`` with the fixture CTEs it (transitively) needs, plus extra CTE text."""
    needed = set()
    deps = {
        "fx_items_wc": ["fx_items", "fx_image_classes"],
        "fx_item_class": ["fx_items", "fx_image_classes"],
        "fx_image_classes": ["fx_ann", "fx_classes"],
        "fx_boxes": ["fx_measures", "fx_classes"],
        "fx_rows": ["fx_ann"],
        "fx_hash0": ["fx_pixels"],
        "fx_hashes": ["fx_hash0"],
    }

    def add(n):
        if n in needed:
            return
        for d in deps.get(n, []):
            add(d)
        needed.add(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({FX[n]})" for n in _FX_ORDER if n in needed]
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
