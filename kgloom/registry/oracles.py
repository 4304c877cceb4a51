"""The registered results in DuckDB SQL, written apart from the Spark jobs."""

from __future__ import annotations

from . import inputs as I

KG = I.oracle(I.RELATION_TABLE)
NODES = I.oracle(I.GRAPH_NODES)
FIRST_IDS = 100


def _padded(c: str) -> str:
    return f"CASE WHEN length({c}) >= 7 THEN {c} ELSE lpad({c}, 7, '0') END"


def _curie(p: str) -> str:
    return f"""CASE WHEN {p}_source = 'NCBI' THEN concat('NCBIGene:', {p}_id)
  WHEN {p}_source = 'REACTOME' THEN concat('REACT:', {p}_id)
  WHEN {p}_source IN ('HPO', 'MONDO', 'UBERON') THEN concat({p}_source, ':', {_padded(p + '_id')})
  WHEN {p}_source IN ('CTD', 'GO', 'DrugBank') THEN concat({p}_source, ':', {p}_id)
  ELSE {p}_source END"""


_MAPPED = """CASE relation
  WHEN 'pathway_pathway' THEN 'biolink:superclass_of'
  WHEN 'anatomy_protein_absent' THEN 'biolink:expressed_in'
  WHEN 'anatomy_protein_present' THEN 'biolink:expressed_in'
  WHEN 'disease_phenotype_negative' THEN 'biolink:has_phenotype'
  WHEN 'disease_phenotype_positive' THEN 'biolink:has_phenotype'
  WHEN 'indication' THEN 'biolink:treats'
  WHEN 'drug_protein' THEN CASE display_relation WHEN 'enzyme' THEN 'biolink:affected_by'
    WHEN 'transporter' THEN 'biolink:affected_by'
    WHEN 'target' THEN 'biolink:directly_physically_interacts_with' ELSE @ELSE END
  ELSE @ELSE END"""

EXPLODED = f"""(SELECT relation, display_relation, x_id, x_source,
  unnest(CASE WHEN y_source = 'MONDO_grouped' THEN string_split(y_id, '_') ELSE [y_id] END) y_id,
  CASE WHEN y_source = 'MONDO_grouped' THEN 'MONDO' ELSE y_source END y_source
  FROM {KG} kg WHERE x_source IS NOT NULL AND y_source IS NOT NULL)"""

CODED = f"""(SELECT relation, display_relation, {_curie('x')} subject, {_MAPPED.replace('@ELSE', 'relation')} predicate,
  {_curie('y')} object FROM {EXPLODED} exploded)"""


def _first(order: str) -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject, predicate, object ORDER BY {order}) place
  FROM {CODED} coded) placed WHERE place = 1)"""


_FIRST = _first("relation, display_relation")
_NONE = "CAST(NULL AS VARCHAR)"
_IS_NEGATIVE = "relation = 'disease_phenotype_negative'"
_IS_TRANSPORT = "relation = 'drug_protein' AND display_relation = 'transporter'"

EDGES = f"""(SELECT predicate, 'knowledge_assertion' knowledge_level, 'not_provided' agent_type,
  'infores:primekg' primary_knowledge_source, {_NONE} aggregator_knowledge_source, {_NONE} original_subject,
  {_NONE} original_object, CASE WHEN {_IS_NEGATIVE} THEN 'true' END negated, {_NONE} publications,
  CASE WHEN {_IS_TRANSPORT} THEN 'transport' END subject_aspect_qualifier,
  CASE WHEN {_IS_TRANSPORT} THEN 'increased' END subject_direction_qualifier,
  {_NONE} object_aspect_qualifier, {_NONE} object_direction_qualifier, {_NONE} upstream_data_source, subject, object
  FROM {_FIRST} first_rows)"""

ENDS = f"(SELECT subject id FROM {EDGES} e UNION ALL SELECT object FROM {EDGES} e)"
CHOSEN = f"(SELECT DISTINCT id FROM {ENDS} ends ORDER BY id LIMIT {FIRST_IDS})"

SAMPLED_SUBSTRING = f"""(SELECT subject, predicate, object FROM {EDGES} e WHERE EXISTS (
  SELECT 1 FROM chosen WHERE contains(e.subject, chosen.id) OR contains(e.object, chosen.id)))"""
SAMPLED_EXACT = f"""(SELECT subject, predicate, object FROM {EDGES} e
  WHERE subject IN (SELECT id FROM chosen) OR object IN (SELECT id FROM chosen))"""
_WITH_CHOSEN = f"WITH chosen AS MATERIALIZED {CHOSEN} "

_LONG = f"""(SELECT '_src' column_name, _src AS value FROM {NODES} n
  UNION ALL SELECT '_acctbal', CAST(_acctbal AS VARCHAR) FROM {NODES} n)"""
_COUNTED = f"(SELECT column_name, value, count(*) counts FROM {_LONG} l GROUP BY column_name, value)"
_PLACED = f"""(SELECT *,
  row_number() OVER (PARTITION BY column_name ORDER BY counts DESC, value ASC NULLS LAST) head,
  row_number() OVER (PARTITION BY column_name ORDER BY counts ASC, value DESC NULLS FIRST) tail,
  least(count(*) OVER (PARTITION BY column_name), 10) size FROM {_COUNTED} counted)"""
HEAD_TAIL = f"""(SELECT column_name, 'head' section, CAST(head AS INT) AS position, value, counts
  FROM {_PLACED} placed WHERE head <= 10
  UNION ALL SELECT column_name, 'tail', CAST(2 * size - tail + 1 AS INT), value, counts
  FROM {_PLACED} placed WHERE tail <= 10)"""


def _long(table: str, columns: list[str]) -> str:
    parts = [f"SELECT '{c}' column_name, CAST({c} AS VARCHAR) AS value FROM {table}" for c in columns]
    return "(" + " UNION ALL ".join(parts) + ")"


def _label_case(family: str) -> str:
    flags = [
        f"CASE WHEN {test} THEN '{name.split(':')[0].removeprefix(family + '_')}' END"
        for name, test in I.LABEL_FLAGS
        if name.startswith(family) and ":" in name
    ]
    return "concat_ws('|', " + ", ".join(flags) + ")"


def _merge_sql(middle: str) -> str:
    a, b, c = (I.oracle(t) for t in (I.MERGE_ORDERS, middle, I.MERGE_PRIORITIES))
    # the first weight keeps its name, the second is marked; sources merge left first
    return f"""SELECT subject, predicate, object, coalesce(a.source, b.source, c.source) source, a.weight weight,
  coalesce(b.evidence, c.evidence) evidence, b.version version, c.weight weight_right
  FROM {a} a FULL JOIN {b} b USING (subject, predicate, object) FULL JOIN {c} c USING (subject, predicate, object)"""


_IDENTIFIERS = f"""(SELECT id, max(identifier) identifier FROM (
  SELECT id, CASE WHEN _src IS NOT NULL AND name IS NOT NULL THEN _src || '/' || name END identifier FROM {NODES} n
) named GROUP BY id)"""

RAW_NODES = I.oracle(I.RAW_NODES)

MARKED_ENDS = f"""(SELECT subject id FROM {EDGES} e WHERE negated IS NOT NULL OR subject_aspect_qualifier IS NOT NULL
  UNION SELECT object FROM {EDGES} e WHERE negated IS NOT NULL OR subject_aspect_qualifier IS NOT NULL)"""
TOUCHED_NODES = f"(SELECT * FROM {NODES} n WHERE id IN (SELECT subject FROM {EDGES} f) OR id IN (SELECT object FROM {EDGES} f))"


def _values(table: str, source: str, column: str, ordinal: int, setting: str = "sample_values", value: str | None = None) -> str:
    kind = "generate_unique_id" if setting == "prefixes" else "generate_values"
    shown = value or f"CAST({column} AS VARCHAR)"
    return f"""SELECT '{table}' table_name, {ordinal} ordinal, '{column}' AS name, '{kind}' AS type, '{setting}' setting, value,
  CAST(NULL AS DOUBLE) number FROM (
  SELECT DISTINCT {shown} AS value FROM {source} s WHERE {column} IS NOT NULL
  UNION ALL SELECT '' WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {column} IS NOT NULL)) v"""


_AGENTS = [
    "manual_agent", "automated_agent", "data_analysis_pipeline", "computational_model", "text_mining_agent",
    "image_processing_agent", "manual_validation_of_automated_agent", "not_provided",
]
_LEVELS = [
    "knowledge_assertion", "logical_entailment", "prediction", "statistical_association", "observation", "not_provided",
]


def _fixed(column: str, ordinal: int, values: list[str]) -> str:
    listed = ", ".join(f"('{v}', {n}.0::DOUBLE)" for n, v in enumerate(values))
    return f"SELECT 'edges', {ordinal}, '{column}', 'generate_values', 'sample_values', v, n FROM (VALUES {listed}) w(v, n)"


def _copied(column: str, ordinal: int) -> str:
    settings = "('source_column', 'nodes.id'), ('seed', '590590'), ('sample.num_rows', '@edges.num_rows')"
    return f"SELECT 'edges', {ordinal}, '{column}', 'copy_column', s, v, NULL FROM (VALUES {settings}) w(s, v)"


def _rows(table: str) -> str:
    return f"SELECT '{table}', -1, NULL, NULL, 'num_rows', '100', NULL"


def _spec_sql(node_columns: list[str], edge_columns: list[str], nodes: str) -> str:
    """Spec rows; ordinals count the columns used, subject and object last."""
    parts = [_values("nodes", nodes, "id", 0, "prefixes", "split_part(id, ':', 1)")]
    parts += [_values("nodes", nodes, c, i + 1) for i, c in enumerate(node_columns)]
    for i, c in enumerate([*edge_columns, "subject", "object"]):
        if c == "agent_type":
            parts.append(_fixed(c, i, _AGENTS))
        elif c in ("knowledge_level", "subject_direction_qualifier", "object_direction_qualifier"):
            parts.append(_fixed(c, i, _LEVELS))
        elif c in ("subject", "object"):
            parts.append(_copied(c, i))
        else:
            parts.append(_values("edges", EDGES, c, i))
    return " UNION ALL ".join([*parts, _rows("nodes"), _rows("edges")])


_ALL_EDGE_COLUMNS = [
    "predicate", "knowledge_level", "agent_type", "primary_knowledge_source", "aggregator_knowledge_source",
    "original_subject", "original_object", "negated", "publications", "subject_aspect_qualifier",
    "subject_direction_qualifier", "object_aspect_qualifier", "object_direction_qualifier", "upstream_data_source",
]


_NODE_TYPES = [("id", "str"), ("category", "str"), ("name", "str"), ("_src", "str"), ("_acctbal", "f64")]


def _snapshot_sql(seed: int, node_columns: list[tuple[str, str]] = _NODE_TYPES) -> str:
    """Header rows with their samples: different values, the first six by a seeded hash."""
    edges = [(c, "str") for c in [*_ALL_EDGE_COLUMNS, "subject", "object"]]
    header, cells = [], []
    for table, source, columns in (("nodes", NODES, node_columns), ("edges", EDGES, edges)):
        for i, (n, t) in enumerate(columns):
            header.append(f"('{table}', {i}, '{n}', '{t}')")
            cells.append(f"SELECT DISTINCT '{table}' AS table_name, {i} AS ordinal, CAST({n} AS VARCHAR) AS value FROM {source} s WHERE {n} IS NOT NULL")
    return f"""(SELECT h.*, coalesce(samples, []) samples FROM (VALUES {", ".join(header)}) h(table_name, ordinal, name, datatype)
  LEFT JOIN (SELECT table_name, ordinal, list(value ORDER BY place) samples FROM (
    SELECT *, row_number() OVER (PARTITION BY table_name, ordinal ORDER BY drawn, value) place FROM (
      SELECT *, md5(concat_ws('|', '{seed}', table_name, CAST(ordinal AS VARCHAR), value)) drawn FROM ({" UNION ALL ".join(cells)}) c))
    WHERE place <= 6 GROUP BY table_name, ordinal) s USING (table_name, ordinal))"""


DRAWN = f"""(WITH ids AS (SELECT id, row_number() OVER (ORDER BY md5('7:' || id), id) - 1 AS number FROM (SELECT DISTINCT id FROM {ENDS} e)),
  draws AS (SELECT ('0x' || substr(md5('draw:7:' || CAST(k AS VARCHAR)), 1, 12))::BIGINT % (SELECT count(*) FROM ids) AS number
    FROM (SELECT unnest(range({FIRST_IDS})) AS k))
  SELECT id, count(*) times FROM ids JOIN draws USING (number) GROUP BY id)"""


ORACLES: dict[str, str] = {
    # building
    "build_edges": f"SELECT * FROM {EDGES} e",
    "build_edges_overwritten": f"""SELECT subject, predicate, object,
  CASE WHEN {_IS_NEGATIVE} OR relation = 'anatomy_protein_absent' THEN 'true' END negated,
  CASE WHEN {_IS_TRANSPORT} THEN 'transport' WHEN relation = 'drug_protein' AND display_relation = 'enzyme' THEN 'amount'
  END subject_aspect_qualifier,
  CASE WHEN {_IS_TRANSPORT} THEN 'increased' END subject_direction_qualifier FROM {_FIRST} f""",
    "build_edges_ordered": f"""SELECT subject, predicate, object, CASE WHEN {_IS_NEGATIVE} THEN 'true' END negated,
  CASE WHEN {_IS_TRANSPORT} THEN 'transport' END subject_aspect_qualifier
  FROM {_first("CASE WHEN display_relation = 'transporter' THEN 0 ELSE 1 END, CASE WHEN relation = 'disease_phenotype_negative' THEN 1 ELSE 0 END")} f""",
    "predicate_mappings": f"""SELECT DISTINCT relation, display_relation, {_MAPPED.replace('@ELSE', 'NULL')} predicate
  FROM {KG} kg""",
    "build_nodes": f"""SELECT CASE node_type WHEN 'pathway' THEN 'biolink:Pathway' WHEN 'gene/protein' THEN 'biolink:Gene'
    WHEN 'disease' THEN 'biolink:Disease' WHEN 'drug' THEN 'biolink:SmallMolecule'
    WHEN 'anatomy' THEN 'biolink:GrossAnatomicalStructure' ELSE node_type END category,
  node_name AS name,
  CASE WHEN node_source = 'NCBI' THEN concat('NCBIGene:', node_id) WHEN node_source = 'REACTOME' THEN concat('REACT:', node_id)
    WHEN node_source IN ('HPO', 'MONDO', 'UBERON') THEN concat(node_source, ':', {_padded('node_id')})
    WHEN node_source IN ('CTD', 'GO', 'DrugBank') THEN concat(node_source, ':', node_id)
    WHEN node_source = 'MONDO_grouped' THEN concat_ws(':', 'MONDO', {_padded('mondo_id')}) ELSE node_source END id,
  description, category drug_category, mondo_id
  FROM {I.oracle(I.FEATURE_NODES)} n FULL JOIN {I.oracle(I.DRUG_FEATURES)} d USING (node_index)
  FULL JOIN {I.oracle(I.DISEASE_FEATURES)} f USING (node_index)""",
    "qualifier_counts": f"""SELECT predicate, negated, subject_aspect_qualifier, count(*) n FROM {EDGES} e
  GROUP BY predicate, negated, subject_aspect_qualifier""",
    "explode_grouped": f"SELECT relation, x_source, x_id, y_source, y_id FROM {EXPLODED} e",
    "endpoint_curies": f"SELECT {_curie('x')} x, {_curie('y')} y FROM {KG} kg",
    # endpoints and integrity
    "endpoint_ids": f"SELECT DISTINCT id FROM {ENDS} ends",
    "endpoint_ids_all": f"SELECT id FROM {ENDS} ends",
    "endpoint_check": f"""SELECT 'nodes' side, id FROM (SELECT id FROM {NODES} n EXCEPT SELECT id FROM {ENDS} e) a
  UNION ALL SELECT 'edges', id FROM (SELECT id FROM {ENDS} e EXCEPT SELECT id FROM {NODES} n) b""",
    "endpoint_check_counts": f"""SELECT 'nodes' side, count(*) n FROM (SELECT id FROM {NODES} n EXCEPT SELECT id FROM {ENDS} e) a
  UNION ALL SELECT 'edges', count(*) FROM (SELECT id FROM {ENDS} e EXCEPT SELECT id FROM {NODES} n) b""",
    "endpoint_nodes": f"SELECT * FROM {NODES} n WHERE id IN (SELECT id FROM {MARKED_ENDS} e)",
    "connected_nodes": f"SELECT * FROM {NODES} n WHERE id IN (SELECT id FROM {ENDS} e)",
    # samples
    "sample_edges_substring": f"{_WITH_CHOSEN} SELECT * FROM {SAMPLED_SUBSTRING} s",
    "sample_nodes_substring": f"""{_WITH_CHOSEN}, sampled AS MATERIALIZED {SAMPLED_SUBSTRING},
  ends AS MATERIALIZED (SELECT subject id FROM sampled UNION SELECT object FROM sampled)
  SELECT * FROM {NODES} n WHERE EXISTS (SELECT 1 FROM ends WHERE contains(n.id, ends.id))""",
    "sample_edges_exact": f"{_WITH_CHOSEN} SELECT * FROM {SAMPLED_EXACT} s",
    "sample_nodes_exact": f"""{_WITH_CHOSEN}, sampled AS MATERIALIZED {SAMPLED_EXACT}
  SELECT * FROM {NODES} n WHERE id IN (SELECT subject FROM sampled) OR id IN (SELECT object FROM sampled)""",
    "substring_ids": f"""WITH ends AS MATERIALIZED (SELECT DISTINCT id FROM {ENDS} e)
  SELECT DISTINCT id FROM {NODES} n WHERE EXISTS (SELECT 1 FROM ends WHERE contains(n.id, ends.id))""",
    "substring_numbers": f"""SELECT DISTINCT id FROM {NODES} n
  WHERE EXISTS (SELECT 1 FROM nation WHERE contains(n.id, CAST(n_nationkey * 37 + 5 AS VARCHAR)))""",
    "sample_random": f"SELECT * FROM {DRAWN} d",
    "sample_random_check": f"""SELECT CAST(sum(times) AS BIGINT) draws,
  count(*) FILTER (id NOT IN (SELECT id FROM {ENDS} e)) AS unknown FROM {DRAWN} d""",
    # columns
    "clean_nodes_header": f"""SELECT id, category AS "__label", name, _src AS "_src", _acctbal AS "_acctbal" FROM {NODES} n""",
    "clean_edges_header": f"""SELECT subject, predicate, object, publications, {_NONE} AS "_upstream" FROM {EDGES} e""",
    "add_edge_columns": f"""SELECT subject, predicate, object,
  CASE WHEN negated IS NULL THEN 'knowledge_assertion' ELSE 'observation' END knowledge_level,
  'data_analysis_pipeline' agent_type, primary_knowledge_source, publications FROM {EDGES} e""",
    "drop_superfluous": f"SELECT id, category, name FROM {NODES} n",
    "keep_superfluous": f"SELECT _src, _acctbal FROM {NODES} n",
    "coalesce_columns": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE o_orderpriority END status
  FROM orders""",
    "fix_delimiter": f"SELECT id, concat_ws('|', _src, category, name) category FROM {NODES} n",
    "bool_to_labels": f"""SELECT concat('DrugBank:', CAST(p_partkey AS VARCHAR)) id, p_name AS name,
  {_label_case('CHEBI_ROLE')} AS "CHEBI_ROLE", {_label_case('MONDO_SUPERCLASS')} AS "MONDO_SUPERCLASS" FROM part""",
    "keep_first": """SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM (SELECT *,
  row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice, o_orderkey) place FROM orders) p
  WHERE place = 1""",
    # profiles
    "superfluous_value_counts": f"SELECT * FROM {HEAD_TAIL} h",
    "superfluous_value_counts_wide": f"""SELECT position,
  max(CASE WHEN column_name = '_src' THEN value END) _src, max(CASE WHEN column_name = '_src' THEN counts END) _src_counts,
  max(CASE WHEN column_name = '_acctbal' THEN value END) _acctbal,
  max(CASE WHEN column_name = '_acctbal' THEN counts END) _acctbal_counts FROM {HEAD_TAIL} h GROUP BY position""",
    "value_counts": f"""SELECT column_name, value, count(*) counts
  FROM {_long('orders', ['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderpriority'])} l GROUP BY column_name, value""",
    "profile_parquet": f"""SELECT column_name, value, counts, CAST(place AS INT) AS rank FROM (SELECT *,
  row_number() OVER (PARTITION BY column_name ORDER BY counts DESC, value ASC NULLS LAST) place FROM (
  SELECT column_name, value, count(*) counts
  FROM {_long('part', ['p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size', 'p_retailprice'])} l GROUP BY column_name, value) c) p
  WHERE place <= 10""",
    "parquet_shape": "SELECT 2 * count(*) num_rows, 11 num_columns FROM lineitem",
    "parquet_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "file_shapes": f"SELECT count(*) data_lines, 5 min_columns, 5 max_columns FROM {NODES} n",
    # text and JSON files
    "delimited_scan": """SELECT CAST(o_orderkey AS VARCHAR) o_orderkey, CAST(o_custkey AS VARCHAR) o_custkey, o_orderstatus,
  CAST(o_totalprice AS VARCHAR) o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') o_orderdate, o_orderpriority FROM orders""",
    "comma_scan": """SELECT CAST(doc_id AS VARCHAR) doc_id, nullif(replace(replace(text, chr(10), ' '), chr(13), ' '), '') AS text,
  lang, source, CAST(n_chars AS VARCHAR) n_chars FROM documents""",
    "multi_line_scan": """SELECT CAST(doc_id AS VARCHAR) doc_id, nullif(text, '') AS text, lang, source,
  CAST(n_chars AS VARCHAR) n_chars FROM documents""",
    "header_tail_scan": f"SELECT _src, CAST(_acctbal AS VARCHAR) _acctbal FROM {NODES} n",
    "mixed_headers_scan": """SELECT CAST(p_partkey AS VARCHAR) p_partkey, p_name, p_brand, NULL AS balance FROM part
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, CAST(s_acctbal AS VARCHAR) FROM supplier""",
    "late_misfit_scan": """SELECT o_orderkey, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'v2.1'
  ELSE CAST(o_custkey AS VARCHAR) END version FROM orders""",
    "sample_names": """SELECT CAST(n_nationkey AS INT) AS size, concat('kg.nodes_', n_nationkey, '.tsv') nodes,
  concat('kg.edges_', n_nationkey, '.tsv') edges FROM nation""",
    "sorted_nodes": f"SELECT category, id, lag(id) OVER (PARTITION BY category ORDER BY id) AS before FROM {NODES} n",
    "inferred_scan": "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) p_size, p_retailprice FROM part",
    "strict_scan": "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "raw_node_scan": f"SELECT id, category, identifier, name FROM {RAW_NODES} n",
    # read by place: the file's second column is the object
    "raw_edge_scan": f"SELECT subject, object, predicate, file FROM {I.oracle(I.RAW_EDGES)} e",
    "kgx_node_scan": f"SELECT id, category FROM {NODES} n",
    "kgx_edge_scan": f"""SELECT subject, predicate, object, primary_knowledge_source, aggregator_knowledge_source,
  knowledge_level, agent_type FROM {EDGES} e""",
    "many_files_scan": f"""SELECT *, 'part-' AS _file FROM (
  SELECT id, category, name, source, NULL AS "EC", NULL description FROM {I.oracle(I.MERGE_SUPPLIERS)} s
  UNION ALL SELECT id, category, name, NULL, "EC", description FROM {I.oracle(I.MERGE_PARTS)} p
  UNION ALL SELECT id, category, NULL, source, NULL, description FROM {I.oracle(I.MERGE_CUSTOMERS)} c) m""",
    "predicate_info_scan": f"SELECT subject, predicate, object, file FROM {I.oracle(I.PATTERNS)} p",
    "category_info_scan": f"""SELECT category, concat('node_', min(_src)) file FROM {NODES} n
  WHERE category = 'biolink:Disease' OR _src = 'part' GROUP BY category""",
    "snapshot_scan": f"SELECT * REPLACE (array_to_string(samples, '|') AS samples) FROM {_snapshot_sql(0)} s",
    "json_sink": f"""SELECT DISTINCT relation, display_relation, {_MAPPED.replace('@ELSE', 'NULL')} predicate FROM {KG} kg""",
    "json_rows": f"""SELECT CAST(to_json(struct_pack(id, category, name, _src, _acctbal := CAST(_acctbal AS VARCHAR))) AS VARCHAR) AS json
  FROM {NODES} n""",
    "json_lookup": "SELECT event_id, 'k' AS name, CAST(json_extract_string(props, '$.k') AS BIGINT) k FROM events",
    "normalization_scan": f"""SELECT identifier, CASE WHEN types IS NOT NULL THEN identifier END preferred_identifier,
  CASE WHEN types IS NOT NULL THEN 'size' END AS label, CASE WHEN types IS NOT NULL THEN identifier END equivalent_identifier,
  replace(types, chr(31), '|') types, CASE WHEN types IS NOT NULL THEN 0.5::DOUBLE END information_content
  FROM {I.oracle(I.NORMALIZATION)} n""",
    # merges
    "merge_edges_fold": _merge_sql(I.MERGE_LINES),
    "merge_edges_split": _merge_sql(I.MERGE_LINES),
    "merge_edges_fast": _merge_sql(I.MERGE_RETURNS),
    "merge_nodes": f"""SELECT id, coalesce(s.name, p.name) AS name, category, coalesce(s.source, c.source) source, p."EC" AS "EC",
  coalesce(p.description, c.description) description FROM {I.oracle(I.MERGE_SUPPLIERS)} s
  FULL JOIN {I.oracle(I.MERGE_PARTS)} p USING (id, category) FULL JOIN {I.oracle(I.MERGE_CUSTOMERS)} c USING (id, category)""",
    # cleaning a raw graph
    "rewrite_endpoints": f"""SELECT e.* REPLACE (coalesce(m.identifier, subject) AS subject)
  FROM {EDGES} e LEFT JOIN {_IDENTIFIERS} m ON m.id = subject""",
    "rewrite_endpoints_both": f"""SELECT e.* REPLACE (coalesce(m.identifier, subject) AS subject,
  CASE WHEN predicate LIKE 'biolink:%' THEN predicate ELSE concat('biolink:', predicate) END AS predicate,
  coalesce(o.identifier, object) AS object)
  FROM {EDGES} e LEFT JOIN {_IDENTIFIERS} m ON m.id = subject LEFT JOIN {_IDENTIFIERS} o ON o.id = object""",
    "id_map": f"SELECT identifier id, max(id) identifier FROM {RAW_NODES} n GROUP BY identifier",
    "normalize_categories": f"""SELECT identifier id, coalesce(types, ancestors) category, name FROM (
  SELECT *, row_number() OVER (PARTITION BY category, identifier ORDER BY id) place FROM {RAW_NODES} n) n
  LEFT JOIN {I.oracle(I.NORMALIZATION)} t USING (identifier)
  LEFT JOIN {I.oracle(I.TERM_ANCESTORS)} a ON term = CASE n.category WHEN 'Compound' THEN 'biolink:SmallMolecule'
    ELSE concat('biolink:', n.category) END
  WHERE place = 1""",
    "clean_graph_edges": f"""SELECT CASE WHEN file <> 'edge_3' THEN coalesce(identifier, subject) ELSE subject END subject,
  object, predicate, file FROM {I.oracle(I.RAW_EDGES)} e LEFT JOIN {RAW_NODES} n ON n.id = e.subject""",
    "category_ancestors": f"""SELECT raw category, replace(ancestors, chr(31), '|') ancestors FROM {I.oracle(I.TERM_ANCESTORS)} t
  JOIN (VALUES ('Anatomy', 'biolink:GrossAnatomicalStructure'), ('Compound', 'biolink:SmallMolecule'),
    ('Disease', 'biolink:Disease'), ('Gene', 'biolink:Gene'), ('Pathway', 'biolink:Pathway'),
    ('PwGroup', 'biolink:Pathway')) v(raw, term) USING (term)""",
    "category_edge_files": f"""SELECT subject category, file FROM {I.oracle(I.PATTERNS)} p
  UNION SELECT object, file FROM {I.oracle(I.PATTERNS)} p""",
    "empty_identifiers": f"SELECT category, bool_and(length(identifier) > 0) complete FROM {RAW_NODES} n GROUP BY category",
    "predicate_prefix": f"SELECT concat('biolink:', relation) predicate FROM {KG} kg",
    # snapshots and specs
    "schema_snapshot": f"SELECT * REPLACE (array_to_string(samples, '|') AS samples) FROM {_snapshot_sql(3, _NODE_TYPES[:4])} s",
    "schema_snapshot_columns": f"""SELECT table_name, ordinal, name, datatype, CAST(len(samples) AS INT) n_samples
  FROM {_snapshot_sql(0)} s""",
    "generation_spec_values": _spec_sql(["category", "name"], _ALL_EDGE_COLUMNS, TOUCHED_NODES),
    "generation_spec_snapshot": _spec_sql(
        ["category"],
        [c for c in _ALL_EDGE_COLUMNS if not c.startswith(("original", "subject_a", "subject_d", "object_"))],
        TOUCHED_NODES,
    ),
    "id_prefixes": f"SELECT DISTINCT split_part(id, ':', 1) prefix FROM {NODES} n",
    "sorted_values": " UNION ALL ".join(
        [_values("edges", EDGES, c, i) for i, c in enumerate(_ALL_EDGE_COLUMNS)]
        + [_copied("subject", len(_ALL_EDGE_COLUMNS)), _copied("object", len(_ALL_EDGE_COLUMNS) + 1), _rows("edges")]
    ),
    "list_repeats": """SELECT doc_id, array_to_string(list_filter(string_split(text, ' '),
  lambda x, i: i = 1 OR x <> string_split(text, ' ')[i - 1]), '|') words FROM documents""",
}
ORACLES["bool_lines_to_labels"] = ORACLES["bool_to_labels"]
ORACLES["merge_nodes_fast"] = ORACLES["merge_nodes"]
