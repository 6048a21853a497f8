"""Fixture views over the driver's tables: each text is valid in Spark SQL and in DuckDB."""

VIEWS = {
    "fx_fire": """
SELECT CONCAT(substr('MTIDWACAORNVAZNMTXFLGAMENYMNCOUTWYOKKSNCVAAKHIPRMI', CAST(c_nationkey AS INT)*2+1, 2),
              lpad(CAST(o_orderkey AS STRING), 11, '0'),
              CAST(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) AS STRING)) AS event_id,
       CAST(o_orderkey AS BIGINT) AS ordinal,
       CAST(o_orderkey % 4 AS INT) AS incid_type,
       CAST(o_orderdate AS DATE) AS ig_date,
       CAST(-2000000 + (o_orderkey*7919) % 4000000 AS DOUBLE) AS minx,
       CAST(400000 + (o_custkey*104729) % 2400000 AS DOUBLE) AS miny,
       CAST(-2000000 + (o_orderkey*7919) % 4000000 + 300 + (o_orderkey*37) % 20000 AS DOUBLE) AS maxx,
       CAST(400000 + (o_custkey*104729) % 2400000 + 300 + (o_custkey*53) % 15000 AS DOUBLE) AS maxy,
       CAST(-120 + (o_orderkey*7919) % 50 AS DOUBLE) AS lon_w, CAST(27 + (o_custkey*31) % 20 AS DOUBLE) AS lat_s,
       CAST(-120 + (o_orderkey*7919) % 50 AS DOUBLE) + 0.25 AS lon_e, CAST(27 + (o_custkey*31) % 20 AS DOUBLE) + 0.2 AS lat_n
FROM orders JOIN customer ON o_custkey = c_custkey
""",
    "fx_scene": """
SELECT CONCAT('LC', lpad(CAST(event_id AS STRING), 8, '0')) AS scene_id,
       DATE '1993-01-01' + CAST((event_id*37) % 3650 AS INT) AS acq_date,
       CAST((event_id*13) % 100 AS DOUBLE) AS cloud_cover,
       CAST(-125 + user_id % 55 AS DOUBLE) AS lon_w, CAST(25 + (event_id*7) % 24 AS DOUBLE) AS lat_s,
       CAST(-125 + user_id % 55 AS DOUBLE) + 2.25 AS lon_e, CAST(25 + (event_id*7) % 24 AS DOUBLE) + 1.75 AS lat_n
FROM events
""",
    "fx_obs": """
SELECT CAST(l_partkey % 20 AS INT) AS row, CAST((l_suppkey + l_orderkey) % 20 AS INT) AS col,
       CAST(year(l_shipdate) AS INT) AS yr, CAST(dayofyear(l_shipdate) AS INT) AS doy,
       CAST((l_orderkey*7 + l_linenumber*13) % 100 AS DOUBLE) AS cloud_cover,
       CAST(7000 + (l_orderkey*19 + l_linenumber*11) % 6000 AS INT) AS dn_blue,
       CAST(7200 + (l_orderkey*23 + l_partkey*5) % 7000 AS INT) AS dn_green,
       CAST(7000 + (l_orderkey*31 + l_partkey*17 + l_linenumber*101) % 9000 AS INT) AS dn_red,
       CAST(9000 + (l_orderkey*13 + l_suppkey*29 + l_linenumber*307) % 18000 AS INT) AS dn_nir08,
       CAST(8000 + (l_partkey*41 + l_linenumber*53 + l_orderkey*7) % 14000 AS INT) AS dn_swir16,
       CAST(7500 + (l_orderkey*11 + l_suppkey*71 + l_partkey*3) % 12000 AS INT) AS dn_swir22,
       CASE (l_orderkey*3 + l_linenumber) % 10 WHEN 0 THEN 1 WHEN 1 THEN 8 WHEN 2 THEN 16 WHEN 3 THEN 128 WHEN 4 THEN 68 ELSE 64 END AS qa_pixel
FROM lineitem
""",
    "fx_def_month": """
SELECT CAST(floor((p_partkey % 16) / 4) AS INT) AS lat_idx, CAST((p_partkey % 16) % 4 AS INT) AS lon_idx,
       CAST(floor(p_partkey / 16) AS INT) + 1 AS mon,
       CASE WHEN (p_partkey % 16) = 5 AND floor(p_partkey / 16) = 3 THEN CAST(NULL AS DOUBLE) ELSE p_retailprice / 10.0 END AS def
FROM part WHERE p_partkey < 192
""",
    "fx_nlcd_dim": """
SELECT idx, code, cat FROM (VALUES (0,11,'Water'),(1,12,'Water'),(2,21,'Developed'),(3,22,'Developed'),(4,23,'Developed'),(5,24,'Developed'),
 (6,31,'Barren'),(7,41,'Forest'),(8,42,'Forest'),(9,43,'Forest'),(10,52,'Shrubland'),(11,71,'Grassland'),(12,81,'Agriculture'),
 (13,82,'Agriculture'),(14,90,'Wetland'),(15,95,'Wetland'),(16,250,NULL)) AS t(idx,code,cat)
""",
    "fx_field_raw": """
SELECT CAST(c_custkey AS BIGINT) AS plot_id, CAST(1996 + c_custkey % 4 AS INT) AS fire_year,
       CAST((c_custkey*7) % 700 AS DOUBLE) + 4.5 AS x, CAST((c_custkey*11) % 620 AS DOUBLE) + 3.5 AS y,
       CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE CAST((c_custkey*29) % 300 AS STRING) END AS cbi_x100
FROM customer
""",
    "fx_forest": """
SELECT tree, node, feat, CAST(thr AS DOUBLE) AS thr, lft, rgt, CAST(val AS DOUBLE) AS val FROM (VALUES
 (0,0,'rbr',100.0,1,2,NULL),(0,1,NULL,NULL,NULL,NULL,0.4),(0,2,'dmirbi',-500.0,3,4,NULL),(0,3,NULL,NULL,NULL,NULL,2.9),(0,4,NULL,NULL,NULL,NULL,1.7),
 (1,0,'post_mirbi',1500.0,1,2,NULL),(1,1,NULL,NULL,NULL,NULL,0.8),(1,2,NULL,NULL,NULL,NULL,2.2),
 (2,0,'dndvi',50.0,1,2,NULL),(2,1,NULL,NULL,NULL,NULL,0.9),(2,2,NULL,NULL,NULL,NULL,2.6)) AS t(tree,node,feat,thr,lft,rgt,val)
""",
    "fx_edge": """
SELECT CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM (VALUES
 (15,15,585,15),(585,15,585,585),(585,585,300,240),(300,240,15,585),(15,585,15,15),
 (60,60,60,180),(60,180,180,180),(180,180,180,60),(180,60,60,60)) AS t(x1,y1,x2,y2)
""",
}
