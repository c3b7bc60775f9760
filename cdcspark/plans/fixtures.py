"""Feeds derived from the supplied tables, as SQL that Spark and DuckDB both run.

``{orders}`` and the like stand for the tables.
"""

ORDERS_FEED = """
SELECT 'shard_a' AS src_db, 'orders' AS tbl, 'S' AS op, CAST(NULL AS BIGINT) AS b_key, CAST(NULL AS VARCHAR(9)) AS b_status, CAST(NULL AS DOUBLE) AS b_price, o_orderkey AS a_key,
       CAST(o_orderstatus AS VARCHAR(9)) AS a_status, o_totalprice AS a_price, '' AS bfile, CAST(0 AS BIGINT) AS pos, 0 AS row_seq FROM {orders}
UNION ALL SELECT 'shard_a','orders','U', o_orderkey, CAST(o_orderstatus AS VARCHAR(9)), o_totalprice, o_orderkey, 'U', o_totalprice + 1, 'binlog.000001', 100 + o_orderkey, 0 FROM {orders} WHERE o_orderkey % 5 = 0
UNION ALL SELECT 'shard_a','orders','D', o_orderkey, CAST(o_orderstatus AS VARCHAR(9)), o_totalprice, NULL, NULL, NULL, 'binlog.000002', 50 + o_orderkey, 0 FROM {orders} WHERE o_orderkey % 7 = 0
UNION ALL SELECT 'shard_a','orders','I', NULL, NULL, NULL, o_orderkey, 'R', 1.0, 'binlog.000002', 50 + o_orderkey, 1 FROM {orders} WHERE o_orderkey % 21 = 0
UNION ALL SELECT 'shard_a','orders','U', o_orderkey, CAST(o_orderstatus AS VARCHAR(9)), o_totalprice, o_orderkey + 10000000, 'K', o_totalprice, 'binlog.000003', o_orderkey, 0 FROM {orders} WHERE o_orderkey % 11 = 0
"""

#: Patches: U rows hold only the columns whose ``has_`` flag is set; status is null where key % 13 = 0.
PATCH_FEED = """
SELECT 'S' AS op, o_orderkey AS k, CAST(o_orderstatus AS VARCHAR(9)) AS status, o_totalprice AS price, TRUE AS has_status, TRUE AS has_price, '' AS bfile, CAST(0 AS BIGINT) AS pos, 0 AS row_seq FROM {orders}
UNION ALL SELECT 'U', o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'P' END, NULL, TRUE, FALSE, 'binlog.000001', o_orderkey, 0 FROM {orders} WHERE o_orderkey % 3 = 0
UNION ALL SELECT 'U', o_orderkey, NULL, o_totalprice * 2, FALSE, TRUE, 'binlog.000001', o_orderkey, 1 FROM {orders} WHERE o_orderkey % 4 = 0
UNION ALL SELECT 'D', o_orderkey, NULL, NULL, TRUE, TRUE, 'binlog.000002', o_orderkey, 0 FROM {orders} WHERE o_orderkey % 10 = 0
UNION ALL SELECT 'U', o_orderkey, 'late', NULL, TRUE, FALSE, 'binlog.000003', o_orderkey, 0 FROM {orders} WHERE o_orderkey % 30 = 0
"""

TWO_SHARDS = """
SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'shard_a' ELSE 'Shard_B' END AS src_db, 'customer' AS tbl, 'S' AS op, CAST(NULL AS BIGINT) AS b_key, CAST(NULL AS VARCHAR(40)) AS b_name, c_custkey AS a_key, CAST(c_name AS VARCHAR(40)) AS a_name, '' AS bfile, CAST(0 AS BIGINT) AS pos, 0 AS row_seq FROM {customer}
UNION ALL SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'Shard_B' ELSE 'shard_a' END, 'customer', 'I', NULL, NULL, c_custkey, CAST(concat(c_name, '-moved') AS VARCHAR(40)), 'binlog.000001', c_custkey, 0 FROM {customer} WHERE c_custkey % 100 = 0
"""

TENANT_FEED = """
SELECT 'shard_a' AS src_db, 'customer' AS tbl, 'S' AS op, CAST(NULL AS BIGINT) AS b_key, CAST(NULL AS BIGINT) AS b_tenant, CAST(NULL AS BIGINT) AS b_project, c_custkey AS a_key, CAST(CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_nationkey END AS BIGINT) AS a_tenant, CAST(CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 25 END AS BIGINT) AS a_project, '' AS bfile, CAST(0 AS BIGINT) AS pos, 0 AS row_seq FROM {customer}
UNION ALL SELECT 'shard_a', 'customer', 'U', c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_nationkey END, CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 25 END, c_custkey, (c_nationkey + 5) % 25, NULL, 'binlog.000001', c_custkey, 0 FROM {customer} WHERE c_custkey % 3 = 0
UNION ALL SELECT 'shard_a', 'customer', 'D', c_custkey, (c_nationkey + 5) % 25, NULL, NULL, NULL, NULL, 'binlog.000002', c_custkey, 0 FROM {customer} WHERE c_custkey % 9 = 0
"""

DRIFTED = """
SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 1 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 100 = 2 THEN o_totalprice + 1 WHEN o_orderkey % 200 = 3 THEN o_totalprice * (1 + 1e-9) ELSE o_totalprice END AS o_totalprice FROM {orders} WHERE o_orderkey % 500 <> 4
UNION ALL SELECT o_orderkey + 50000000, o_orderstatus, o_totalprice FROM {orders} WHERE o_orderkey % 500 = 5
"""

#: Catalog rows of one table for each row of ``part``: names, types and keys follow from its number.
TABLE_NAME = "concat(CASE p_partkey % 7 WHEN 0 THEN 'tmp_' WHEN 1 THEN 'log' ELSE 'Tab' END, CAST(p_partkey AS VARCHAR(20)), CASE WHEN p_partkey % 2 = 0 THEN 's' ELSE '' END)"
CATALOG = f"""
SELECT {TABLE_NAME} AS tbl, 'Id' AS "column", CASE p_partkey % 5 WHEN 0 THEN 'BIGINT(20)' WHEN 1 THEN 'varchar(64)' WHEN 2 THEN 'varchar(600)' WHEN 3 THEN 'text' ELSE 'int' END AS type, FALSE AS nullable, p_partkey % 11 <> 0 AS is_pk, FALSE AS generated FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 'line', 'int', FALSE, TRUE, FALSE FROM {{part}} WHERE p_partkey % 6 = 0
UNION ALL SELECT {TABLE_NAME}, 'status', concat('varchar(', CAST(p_size + 5 AS VARCHAR(9)), ')'), p_partkey % 3 <> 0, FALSE, FALSE FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 'price', concat('decimal(', CAST(10 + p_partkey % 4 AS VARCHAR(9)), ',2)'), TRUE, FALSE, FALSE FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 'total', 'int(11)', TRUE, FALSE, TRUE FROM {{part}} WHERE p_partkey % 4 = 0
UNION ALL SELECT {TABLE_NAME}, 'tenant_id', CASE WHEN p_partkey % 2 = 0 THEN 'int(10) unsigned' ELSE 'smallint unsigned' END, TRUE, FALSE, FALSE FROM {{part}} WHERE p_partkey % 3 <> 0
UNION ALL SELECT {TABLE_NAME}, 'project_id', 'bigint', p_partkey % 2 = 0, FALSE, FALSE FROM {{part}} WHERE p_partkey % 5 = 0
"""

CATALOG_TARGET = f"""
SELECT {TABLE_NAME} AS tbl, 'ID' AS "column", CASE p_partkey % 3 WHEN 0 THEN 'bigint' WHEN 1 THEN 'int' ELSE 'varchar(64)' END AS type, FALSE AS nullable FROM {{part}} WHERE p_partkey % 13 <> 0
UNION ALL SELECT {TABLE_NAME}, 'line', 'smallint', FALSE FROM {{part}} WHERE p_partkey % 6 = 0
UNION ALL SELECT {TABLE_NAME}, 'status', 'varchar(30)', FALSE FROM {{part}} WHERE p_partkey % 13 <> 0
UNION ALL SELECT {TABLE_NAME}, 'price', 'decimal(12,2)', TRUE FROM {{part}} WHERE p_partkey % 13 <> 0
UNION ALL SELECT {TABLE_NAME}, 'tenant_id', 'int', FALSE FROM {{part}} WHERE p_partkey % 3 <> 0
UNION ALL SELECT concat('only', CAST(p_partkey AS VARCHAR(20))), 'id', 'int', FALSE FROM {{part}} WHERE p_partkey % 17 = 0
"""

#: Foreign keys between those tables (every third one's parent is the table with half its number), of one or two columns.
OTHER_NAME = TABLE_NAME.replace("p_partkey", "(p_partkey - p_partkey % 2)")
FKS = f"""
SELECT {TABLE_NAME} AS child, concat('fk', CAST(p_partkey AS VARCHAR(20))) AS name, {OTHER_NAME} AS parent, 1 AS seq, 'tenant_id' AS "column", 'Id' AS parent_column FROM {{part}} WHERE p_partkey % 9 = 1
UNION ALL SELECT {TABLE_NAME}, concat('fk', CAST(p_partkey AS VARCHAR(20))), {OTHER_NAME}, 2, 'status', 'line' FROM {{part}} WHERE p_partkey % 9 = 1 AND p_partkey % 2 = 0
UNION ALL SELECT {TABLE_NAME}, concat('lost', CAST(p_partkey AS VARCHAR(20))), concat('missing', CAST(p_size AS VARCHAR(9))), 1, 'status', 'Id' FROM {{part}} WHERE p_partkey % 29 = 3
"""

INDEXES = f"""
SELECT {TABLE_NAME} AS tbl, 'i1' AS idx, 2 AS seq, 'status' AS "column", 'BTREE' AS kind, CAST(CASE WHEN p_partkey % 10 = 0 THEN p_size END AS INT) AS prefix FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 'i1', 1, CASE WHEN p_partkey % 8 <> 0 THEN 'price' END, 'btree', CAST(NULL AS INT) FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 'i2', 1, 'status', 'FULLTEXT', CAST(NULL AS INT) FROM {{part}} WHERE p_partkey % 4 = 1
"""

#: Stored positions: fixed ones, one of each customer's table for each order, blank and zero ones among them.
POSITIONS = """
SELECT * FROM (VALUES ('table','orders','binlog.000002',CAST(500 AS BIGINT),1),('table','Customer','binlog.000001',CAST(120 AS BIGINT),3),('stream','main','binlog.999999',CAST(4 AS BIGINT),6),('stream','main','binlog.1000000',CAST(4 AS BIGINT),7)) AS t(kind, "key", bfile, pos, updated_at)
UNION ALL SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'stream' ELSE 'table' END, concat(CASE WHEN o_orderkey % 3 = 0 THEN 'T' ELSE 't' END, CAST(o_custkey AS VARCHAR(20))), CASE WHEN o_orderkey % 19 = 0 THEN ' ' ELSE concat('binlog.', CAST(1 + o_orderkey % 3 AS VARCHAR(9))) END, CASE WHEN o_orderkey % 23 = 0 THEN CAST(0 AS BIGINT) ELSE o_orderkey END, CAST(10 + o_orderkey AS INT) FROM {orders}
UNION ALL SELECT 'table', 'CUSTOMER', 'binlog.000001', 200 + o_orderkey, CAST(10 + o_orderkey AS INT) FROM {orders} WHERE o_orderkey % 50 = 0
"""

DATES = """
SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS d FROM {orders}
UNION ALL SELECT * FROM (VALUES (CAST(-1 AS BIGINT), CAST('2024-01-31 23:59:58' AS TIMESTAMP)), (CAST(-2 AS BIGINT), CAST('2024-02-29 00:00:00' AS TIMESTAMP)), (CAST(-3 AS BIGINT), CAST('2023-12-31 12:00:00' AS TIMESTAMP))) AS v(id, d)
"""

TEXTS = """
SELECT c_custkey AS id, CAST(c_name AS VARCHAR(99)) AS s FROM {customer}
UNION ALL SELECT * FROM (VALUES (CAST(-1 AS BIGINT), ',a'), (CAST(-2 AS BIGINT), ''), (CAST(-3 AS BIGINT), '中文 é'), (CAST(-4 AS BIGINT), ' a , ,b,'), (CAST(-5 AS BIGINT), 'x,y,z'), (CAST(-6 AS BIGINT), NULL)) AS v(id, s)
"""

#: Parts as a table that refers to itself (a third of a part's number is its parent's), with some circles, and lines that refer to parts.
PART_LINKS = """
SELECT 'part' AS ptbl, CAST(CASE WHEN p_partkey % 40 = 1 THEN p_partkey + 1 WHEN p_partkey % 40 = 2 THEN p_partkey - 1 ELSE floor(p_partkey / 3) END AS BIGINT) AS pkey, 'part' AS tbl, CAST(p_partkey AS BIGINT) AS "key", CASE WHEN p_partkey % 7 = 0 THEN 'SET NULL' ELSE 'CASCADE' END AS action FROM {part} WHERE p_partkey > 2
UNION ALL SELECT 'part', CAST(l_partkey AS BIGINT), 'line', l_orderkey * 10 + l_linenumber, 'CASCADE' FROM {lineitem}
"""

#: A batch over parts, in chains, and lines that refer to them; deletes refer to rows deleted.
WAVE_ROWS = """
SELECT 'part' AS tbl, CAST(p_partkey AS BIGINT) AS "key", CASE WHEN p_partkey % 4 = 0 THEN 'D' ELSE 'U' END AS kind, 'part' AS ptbl, CAST(CASE WHEN p_partkey % 4 = 0 THEN floor(p_partkey / 8) * 4 ELSE p_partkey - p_partkey % 10 - 9 END AS BIGINT) AS pkey FROM {part} WHERE p_partkey % 9 <> 0
UNION ALL SELECT 'line', l_orderkey * 10 + l_linenumber, CASE WHEN min(l_partkey) % 4 = 0 THEN 'D' ELSE 'U' END, 'part', CAST(min(l_partkey) AS BIGINT) FROM {lineitem} GROUP BY l_orderkey, l_linenumber
"""

#: Layouts of five tables along the log; table 0 has most rows.
LAYOUT_TABLE = "concat(CASE WHEN o_orderkey % 2 = 0 THEN 'T' ELSE 't' END, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 5 ELSE 0 END AS VARCHAR(9)))"
LAYOUT_FEED = f"""
SELECT {LAYOUT_TABLE} AS tbl, concat('binlog.', CAST(998 + o_orderkey % 4 AS VARCHAR(9))) AS bfile, o_orderkey * 37 AS pos, CAST(o_orderkey AS VARCHAR(20)) AS v1, CAST(o_orderstatus AS VARCHAR(9)) AS v2, CAST(o_custkey AS VARCHAR(20)) AS v3 FROM {{orders}}
"""
LAYOUTS = """
SELECT DISTINCT concat('t', CAST(o_orderkey % 5 AS VARCHAR(9))) AS tbl, concat('binlog.', CAST(998 + o_custkey % 4 AS VARCHAR(9))) AS bfile, o_orderkey * 37 AS pos, CASE WHEN o_orderkey % 2 = 0 THEN 'id' ELSE 'key' END AS n1, CASE WHEN o_custkey % 3 = 0 THEN 'hidden' ELSE 'state' END AS n2, CASE WHEN o_custkey % 2 = 0 THEN 'customer' END AS n3 FROM {orders} WHERE o_orderkey % 97 = 5
"""

#: CREATE TABLE texts of the tables named by ``part``: in one line or several, with comments and defaults that hold commas, brackets and keywords.
DDL_NOTE = "concat('not null, generated always (', CAST(p_partkey AS VARCHAR(20)), ') it''s; -- key')"
DDL = f"""
SELECT {TABLE_NAME} AS tbl, concat('CREATE TABLE `', {TABLE_NAME}, '` (', CASE WHEN p_partkey % 2 = 0 THEN chr(10) ELSE '' END, '`Id` bigint(20) unsigned NOT NULL AUTO_INCREMENT, /* the ` key, */ `no``te` varchar(', CAST(p_size + 5 AS VARCHAR(9)), ') DEFAULT ''a, (b'' COMMENT ''', replace({DDL_NOTE}, '''', ''''''), ''',', CASE WHEN p_partkey % 2 = 0 THEN chr(10) ELSE ' ' END,
  'price decimal(', CAST(10 + p_partkey % 4 AS VARCHAR(9)), ', 2) ', CASE WHEN p_partkey % 3 = 0 THEN 'NOT NULL DEFAULT (0)' ELSE 'NULL DEFAULT NULL' END, ', at timestamp(3) NOT NULL DEFAULT ', CASE WHEN p_partkey % 2 = 0 THEN 'NOW(3)' ELSE 'CURRENT_TIMESTAMP(3)' END, ' ON UPDATE CURRENT_TIMESTAMP(3),',
  ' `twice` int GENERATED ALWAYS AS (`Id` * 2) STORED', CASE WHEN p_partkey % 4 = 0 THEN ', kind enum(''x,y'',''z'') DEFAULT ''z''' ELSE '' END, ', ', CASE WHEN p_partkey % 5 = 0 THEN 'CONSTRAINT `pk` ' ELSE '' END, 'PRIMARY KEY (`Id`', CASE WHEN p_partkey % 3 = 0 THEN ', `no``te`(10) DESC' ELSE '' END, '), KEY `i` (`price`)) ENGINE=x COMMENT=''a, b (c''') AS ddl FROM {{part}}
"""
#: What those texts declare.
DDL_COLUMNS = f"""
SELECT {TABLE_NAME} AS tbl, 1 AS ordinal, 'Id' AS "column", 'bigint(20) unsigned' AS type, FALSE AS nullable, TRUE AS auto, FALSE AS generated, TRUE AS is_pk, CAST(NULL AS VARCHAR(99)) AS "default", CAST(NULL AS VARCHAR(99)) AS comment FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 2, 'no`te', concat('varchar(', CAST(p_size + 5 AS VARCHAR(9)), ')'), p_partkey % 3 <> 0, FALSE, FALSE, p_partkey % 3 = 0, '''a, (b''', {DDL_NOTE} FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 3, 'price', concat('decimal(', CAST(10 + p_partkey % 4 AS VARCHAR(9)), ',2)'), p_partkey % 3 <> 0, FALSE, FALSE, FALSE, CASE WHEN p_partkey % 3 = 0 THEN '(0)' ELSE 'NULL' END, NULL FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 4, 'at', 'timestamp(3)', FALSE, FALSE, FALSE, FALSE, CASE WHEN p_partkey % 2 = 0 THEN 'NOW(3)' ELSE 'CURRENT_TIMESTAMP(3)' END, NULL FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 5, 'twice', 'int', TRUE, FALSE, TRUE, FALSE, NULL, NULL FROM {{part}}
UNION ALL SELECT {TABLE_NAME}, 6, 'kind', 'enum(''x,y'',''z'')', TRUE, FALSE, FALSE, FALSE, '''z''', NULL FROM {{part}} WHERE p_partkey % 4 = 0
"""
#: What the target has instead: other defaults of ``kind`` and comments of some tables, the same defaults in other writings else.
DDL_STORED = f"""
SELECT tbl, lower("column") AS "column", CASE WHEN "column" = 'at' THEN 'CURRENT_TIMESTAMP' WHEN "column" = 'kind' AND length(tbl) % 2 <> 0 THEN '''y''' WHEN "default" = '(0)' THEN '0' ELSE "default" END AS "default", CASE WHEN length(tbl) % 3 = 0 THEN concat(comment, '!') ELSE comment END AS comment FROM ({DDL_COLUMNS}) d WHERE "column" <> 'Id'
"""
