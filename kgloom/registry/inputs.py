"""The given tables seen as a knowledge graph.

Each input is one SQL text that both engines read, so a job and its oracle start
from the same rows. ``{name}`` stands for a given table.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]

_GROUPED = {
    "spark": "array_join(array_sort(collect_list(CAST(c_custkey AS STRING))), '_')",
    "duckdb": "array_to_string(list_sort(list(CAST(c_custkey AS STRING))), '_')",
}

RELATION_TABLE = """
SELECT 'drug_protein' relation,
  CASE l_returnflag WHEN 'A' THEN 'enzyme' WHEN 'N' THEN 'target' ELSE 'transporter' END display_relation,
  CAST(l_partkey AS STRING) x_id, 'drug' x_type, 'DrugBank' x_source,
  CAST(l_suppkey AS STRING) y_id, 'gene/protein' y_type, 'NCBI' y_source
FROM (SELECT DISTINCT l_returnflag, l_partkey, l_suppkey FROM {lineitem}) sold
UNION ALL
SELECT CASE WHEN s_acctbal < 0 THEN 'anatomy_protein_absent' ELSE 'anatomy_protein_present' END, 'expression',
  CAST(s_suppkey AS STRING), 'gene/protein', 'NCBI', CAST(s_nationkey AS STRING), 'anatomy', 'UBERON'
FROM {supplier}
UNION ALL
SELECT 'pathway_pathway', 'parent-child', concat('R-', CAST(r_regionkey AS STRING)), 'pathway', 'REACTOME',
  concat('N-', CAST(n_nationkey AS STRING)), 'pathway', 'REACTOME'
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT CASE WHEN negative THEN 'disease_phenotype_negative' ELSE 'disease_phenotype_positive' END,
  'phenotype', CAST(c_custkey AS STRING), 'disease', 'MONDO',
  CAST(c_nationkey AS STRING), 'effect/phenotype', 'HPO'
FROM {customer} JOIN (SELECT DISTINCT o_custkey, o_orderstatus = 'F' negative FROM {orders}) seen
  ON o_custkey = c_custkey
UNION ALL
SELECT event_type, 'event', CAST(user_id AS STRING), 'exposure', 'CTD', event_type, 'biological_process', 'GO'
FROM (SELECT DISTINCT event_type, user_id FROM {events}) seen
UNION ALL
SELECT 'indication', 'indication', CAST(n_nationkey AS STRING), 'drug',
  CASE WHEN n_nationkey = 7 THEN NULL ELSE 'DrugBank' END, ids, 'disease', 'MONDO_grouped'
FROM {nation} JOIN (
  SELECT c_nationkey, @GROUPED ids FROM {customer} GROUP BY c_nationkey, c_mktsegment
) g ON c_nationkey = n_nationkey
"""

GRAPH_NODES = """
SELECT concat('NCBIGene:', CAST(s_suppkey AS STRING)) id, 'biolink:Gene' category, s_name name,
  'supplier' _src, s_acctbal _acctbal FROM {supplier}
UNION ALL SELECT concat('DrugBank:', CAST(p_partkey AS STRING)), 'biolink:SmallMolecule', p_name,
  'part', p_retailprice FROM {part}
UNION ALL SELECT concat('MONDO:', lpad(CAST(c_custkey AS STRING), 7, '0')), 'biolink:Disease', c_name,
  'customer', c_acctbal FROM {customer}
UNION ALL SELECT concat('UBERON:', lpad(CAST(n_nationkey AS STRING), 7, '0')), 'biolink:GrossAnatomicalStructure',
  n_name, 'nation', NULL FROM {nation}
UNION ALL SELECT concat('REACT:R-', CAST(r_regionkey AS STRING)), 'biolink:Pathway', r_name, 'region', NULL
FROM {region}
UNION ALL SELECT DISTINCT concat('UMLS:', CAST(user_id AS STRING)), 'biolink:NamedThing', CAST(NULL AS STRING),
  'user', CAST(NULL AS DOUBLE) FROM {events}
UNION ALL SELECT concat('CTD:', CAST(user_id AS STRING)), 'biolink:ChemicalExposure',
  concat('exposure ', CAST(user_id AS STRING)), 'exposure', max(value) FROM {events} GROUP BY user_id
"""

FEATURE_NODES = """
SELECT concat('s', CAST(s_suppkey AS STRING)) node_index, CAST(s_suppkey AS STRING) node_id,
  'gene/protein' node_type, s_name node_name, 'NCBI' node_source FROM {supplier}
UNION ALL SELECT concat('p', CAST(p_partkey AS STRING)), CAST(p_partkey AS STRING), 'drug', p_name, 'DrugBank'
FROM {part}
UNION ALL SELECT concat('c', CAST(c_custkey AS STRING)), CAST(c_custkey AS STRING), 'disease', c_name,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'MONDO_grouped' ELSE 'MONDO' END FROM {customer}
UNION ALL SELECT concat('n', CAST(n_nationkey AS STRING)), CAST(n_nationkey AS STRING), 'anatomy', n_name, 'UBERON'
FROM {nation}
UNION ALL SELECT concat('r', CAST(r_regionkey AS STRING)), concat('R-', CAST(r_regionkey AS STRING)), 'pathway',
  r_name, 'REACTOME' FROM {region}
"""

# every fourth drug's features have no node, and so that drug no features
DRUG_FEATURES = """
SELECT concat(CASE WHEN p_partkey % 4 = 0 THEN 'q' ELSE 'p' END, CAST(p_partkey AS STRING)) node_index,
  p_type description, p_brand category FROM {part}
"""

# a row for each customer, two for every second; those of every third have no node
DISEASE_FEATURES = """
SELECT concat(CASE WHEN c_custkey % 3 = 0 THEN 'd' ELSE 'c' END, CAST(c_custkey AS STRING)) node_index,
  CAST(c_custkey AS STRING) mondo_id FROM {customer}
UNION ALL SELECT concat('c', CAST(c_custkey AS STRING)), CAST(c_custkey + 100000 AS STRING)
FROM {customer} WHERE c_custkey % 2 = 0
"""

# three edge files whose keys overlap in part; urgent orders have no subject
MERGE_ORDERS = """
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
    ELSE concat(CASE WHEN o_orderkey % 3 = 0 THEN 'ORDER-A:' ELSE 'ORDER:' END, CAST(o_orderkey AS STRING)) END subject,
  'biolink:related_to' predicate, concat('CUSTOMER:', CAST(o_custkey AS STRING)) object,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END source, o_totalprice weight
FROM {orders}
"""
MERGE_PRIORITIES = """
SELECT concat(CASE WHEN o_orderkey % 5 = 0 THEN 'ORDER-B:' ELSE 'ORDER:' END, CAST(o_orderkey AS STRING)) subject,
  'biolink:related_to' predicate,
  concat('CUSTOMER:', CAST(o_custkey AS STRING)) object, o_orderpriority source, o_orderpriority evidence,
  o_totalprice weight
FROM {orders}
"""
MERGE_LINES = """
SELECT concat(CASE WHEN l_orderkey % 7 = 0 THEN 'ORDER-C:' ELSE 'ORDER:' END, CAST(o_orderkey AS STRING)) subject,
  'biolink:related_to' predicate,
  concat('CUSTOMER:', CAST(o_custkey AS STRING)) object, l_linestatus source, l_returnflag evidence,
  CAST(l_linenumber AS STRING) version
FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
"""
MERGE_RETURNS = """
SELECT subject, predicate, object, max(source) source, max(evidence) evidence, max(version) version
FROM (@LINES) lines GROUP BY subject, predicate, object
""".replace("@LINES", MERGE_LINES)

MERGE_SUPPLIERS = """
SELECT concat('KEY:', CAST(s_suppkey AS STRING)) id, 'biolink:NamedThing' category, s_name name,
  CAST(s_nationkey AS STRING) source FROM {supplier}
"""
MERGE_PARTS = """
SELECT concat('KEY:', CAST(p_partkey AS STRING)) id, 'biolink:NamedThing' category, p_name name, p_brand EC,
  p_type description FROM {part}
"""
MERGE_CUSTOMERS = """
SELECT concat('KEY:', CAST(c_custkey AS STRING)) id, 'biolink:NamedThing' category, c_mktsegment source,
  c_name description FROM {customer}
"""

# raw graph: many parts share one identifier, as do the customers of a nation
RAW_NODES = """
SELECT concat('p', CAST(p_partkey AS STRING)) id, 'Compound' category,
  concat('PUBCHEM:', CAST(p_size AS STRING)) identifier, p_name name FROM {part}
UNION ALL SELECT concat('s', CAST(s_suppkey AS STRING)), 'Gene', concat('NCBIGene:', CAST(s_suppkey AS STRING)), s_name
FROM {supplier}
UNION ALL SELECT concat('c', CAST(c_custkey AS STRING)), 'Disease', concat('DOID:', CAST(c_nationkey AS STRING)), c_name
FROM {customer}
"""
RAW_EDGES = """
SELECT concat('p', CAST(l_partkey AS STRING)) subject, concat('s', CAST(l_suppkey AS STRING)) object,
  'BINDS' predicate, 'edge_1' file FROM (SELECT DISTINCT l_partkey, l_suppkey FROM {lineitem}) sold
UNION ALL SELECT concat('c', CAST(o_custkey AS STRING)), o_orderpriority, 'HAS', 'edge_2'
FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM {orders}) seen
UNION ALL SELECT concat('s', CAST(s_suppkey AS STRING)), CAST(s_nationkey AS STRING), 'IN', 'edge_3' FROM {supplier}
"""
# edge_3 is about no raw category here, so its subjects stay
PREDICATE_INFO = """
SELECT 'Compound' subject, 'BINDS' predicate, 'Gene' object, 'edge_1' file FROM {region} WHERE r_name = 'ASIA'
UNION ALL SELECT 'Disease', 'HAS', 'Symptom', 'edge_2' FROM {region} WHERE r_name = 'ASIA'
UNION ALL SELECT 'Place', 'IN', 'Place', 'edge_3' FROM {region} WHERE r_name = 'ASIA'
"""
# identifier -> types by part size; larger sizes have a null record
NORMALIZATION = """
SELECT concat('PUBCHEM:', CAST(p_size AS STRING)) identifier,
  CASE WHEN p_size <= 25 THEN concat('biolink:SmallMolecule', chr(31), 'biolink:', min(p_type)) END types FROM {part} GROUP BY p_size
"""
TERM_ANCESTORS = "SELECT category term, concat(category, chr(31), 'biolink:NamedThing') ancestors FROM (@NODES) n GROUP BY category".replace(
    "@NODES", GRAPH_NODES
)

PATTERNS = "SELECT DISTINCT x_type subject, relation predicate, y_type object, concat('edges_', relation) file FROM (@KG) kg".replace(
    "@KG", RELATION_TABLE
)

# sizes and kinds of parts as one-hot text flags
_FLAGS = [(f"CHEBI_ROLE_size{n}:boolean", f"p_size > {n} AND p_size <= {n + 10}") for n in (0, 10, 20, 30, 40)]
_KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_FLAGS += [(f"MONDO_SUPERCLASS_{k.lower()}:boolean", f"p_type = '{k}'") for k in _KINDS]
_FLAGS += [("MONDO_SUPERCLASS_unnamed", "p_size > 0")]
LABEL_FLAGS = _FLAGS
ONE_HOT_NODES = (
    "SELECT concat('DrugBank:', CAST(p_partkey AS STRING)) AS @Qid:ID@Q, p_name AS @Qname:string@Q, "
    + ", ".join(f"CASE WHEN {test} THEN 'true' ELSE 'false' END AS @Q{name}@Q" for name, test in _FLAGS)
    + " FROM {part}"
)


def sql_for(engine: str, text: str, tables: dict[str, str]) -> str:
    """The input text for one engine, its table marks filled in."""
    text = text.replace("@GROUPED", _GROUPED[engine]).replace("@Q", "`" if engine == "spark" else '"')
    for name, value in tables.items():
        text = text.replace("{" + name + "}", value)
    return text


def oracle(text: str) -> str:
    """The input as a DuckDB sub-query."""
    return "(" + sql_for("duckdb", text, {t: t for t in TABLES}).strip() + ")"


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The frame of a given table; its file list and schema are looked up once."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The input as a Spark frame over the tables it names."""
    used = [t for t in TABLES if "{" + t + "}" in text]
    return spark.sql(sql_for("spark", text, {}), **{t: table(spark, sf_dir, t) for t in used})
