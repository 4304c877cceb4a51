"""Names, vocabularies and mappings that results must carry.

These lists are data, not logic. They are stated in full and in natural order.
"""

from __future__ import annotations

PIPE = "|"
UNIT_SEPARATOR = "\x1f"
BIOLINK = "biolink:"

# --- fixed values: column names -------------------------------------------------

PRIMARY_NODE_COLUMNS = [
    "id",
    "category",
    "original_id",
    "all_categories",
    "name",
    "description",
    "equivalent_identifiers",
    "publications",
    "labels",
    "international_resource_identifier",
]

PRIMARY_EDGE_COLUMNS = [
    "subject",
    "predicate",
    "object",
    "publications",
    "knowledge_level",
    "agent_type",
    "primary_knowledge_source",
    "subject_aspect_qualifier",
    "subject_direction_qualifier",
    "object_aspect_qualifier",
    "object_direction_qualifier",
    "aggregator_knowledge_source",
    "original_subject",
    "original_object",
]

ENSURED_EDGE_COLUMNS = [
    "knowledge_level",
    "agent_type",
    "primary_knowledge_source",
    "aggregator_knowledge_source",
    "publications",
    "subject_aspect_qualifier",
    "subject_direction_qualifier",
    "object_aspect_qualifier",
    "object_direction_qualifier",
]

NODE_COALESCE_COLUMNS = [
    "name",
    "source",
    "description",
    "license",
    "url",
    "synonyms",
    "vestige",
    "sources",
    "accession",
    "chembl_id",
    "org_name",
    "reviewed",
    "EC",
    "org_ncbi_id",
    "gene",
    "start",
    "end",
    "polyprotein",
    "isoform",
]

EDGE_COALESCE_COLUMNS = [
    "source",
    "sources",
    "unbiased",
    "evidence",
    "vestige",
    "version",
    "p_value",
    "direction",
    "alternative_allele",
    "reference_allele",
]

# --- fixed values: generation-spec vocabularies -----------------------------------

AGENT_TYPES = [
    "manual_agent",
    "automated_agent",
    "data_analysis_pipeline",
    "computational_model",
    "text_mining_agent",
    "image_processing_agent",
    "manual_validation_of_automated_agent",
    "not_provided",
]

KNOWLEDGE_LEVELS = [
    "knowledge_assertion",
    "logical_entailment",
    "prediction",
    "statistical_association",
    "observation",
    "not_provided",
]

# Both direction qualifiers carry the knowledge levels; callers may override.
EDGE_VOCABULARIES = {
    "agent_type": AGENT_TYPES,
    "knowledge_level": KNOWLEDGE_LEVELS,
    "object_direction_qualifier": KNOWLEDGE_LEVELS,
    "subject_direction_qualifier": KNOWLEDGE_LEVELS,
}

# --- fixed values: relation -> predicate -------------------------------------------

RELATION_PREDICATES = {
    "bioprocess_protein": "biolink:interacts_with",
    "cellcomp_protein": "biolink:interacts_with",
    "exposure_bioprocess": "biolink:interacts_with",
    "exposure_cellcomp": "biolink:interacts_with",
    "exposure_molfunc": "biolink:interacts_with",
    "exposure_protein": "biolink:interacts_with",
    "molfunc_protein": "biolink:interacts_with",
    "pathway_protein": "biolink:interacts_with",
    "disease_protein": "biolink:associated_with",
    "phenotype_protein": "biolink:associated_with",
    "anatomy_anatomy": "biolink:superclass_of",
    "bioprocess_bioprocess": "biolink:superclass_of",
    "cellcomp_cellcomp": "biolink:superclass_of",
    "disease_disease": "biolink:superclass_of",
    "exposure_exposure": "biolink:superclass_of",
    "molfunc_molfunc": "biolink:superclass_of",
    "pathway_pathway": "biolink:superclass_of",
    "phenotype_phenotype": "biolink:superclass_of",
    "protein_protein": "biolink:interacts_with",
    "drug_effect": "biolink:has_side_effect",
    "contraindication": "biolink:contraindicated_in",
    "anatomy_protein_absent": "biolink:expressed_in",
    "anatomy_protein_present": "biolink:expressed_in",
    "disease_phenotype_negative": "biolink:has_phenotype",
    "disease_phenotype_positive": "biolink:has_phenotype",
    "exposure_disease": "biolink:correlated_with",
    "indication": "biolink:treats",
    "off-label use": "biolink:applied_to_treat",
    "drug_drug": "biolink:directly_physically_interacts_with",
}

# relation, display_relation -> predicate
DISPLAY_PREDICATES = {
    ("drug_protein", "enzyme"): "biolink:affected_by",
    ("drug_protein", "target"): "biolink:directly_physically_interacts_with",
    ("drug_protein", "carrier"): "biolink:affected_by",
    ("drug_protein", "transporter"): "biolink:affected_by",
}

# relation, display_relation (None: any) -> extra edge columns
QUALIFIERS = {
    ("disease_phenotype_negative", None): {"negated": "true"},
    ("drug_protein", "transporter"): {
        "subject_aspect_qualifier": "transport",
        "subject_direction_qualifier": "increased",
    },
}

# Extra columns that a later rule blanks again; only kept on request.
OVERWRITTEN_QUALIFIERS = {
    ("anatomy_protein_absent", None): {"negated": "true"},
    ("drug_protein", "enzyme"): {"subject_aspect_qualifier": "amount"},
}

RELATION_EDGE_CONSTANTS = {
    "knowledge_level": "knowledge_assertion",
    "agent_type": "not_provided",
    "primary_knowledge_source": "infores:primekg",
    "aggregator_knowledge_source": None,
    "original_subject": None,
    "original_object": None,
    "negated": None,
    "publications": None,
    "subject_aspect_qualifier": None,
    "subject_direction_qualifier": None,
    "object_aspect_qualifier": None,
    "object_direction_qualifier": None,
    "upstream_data_source": None,
}

RELATION_COLUMNS = [
    "relation",
    "display_relation",
    "x_index",
    "x_id",
    "x_type",
    "x_name",
    "x_source",
    "y_index",
    "y_id",
    "y_type",
    "y_name",
    "y_source",
]

# --- fixed values: node type -> category, tested in this order by substring ----------

NODE_TYPE_CATEGORIES = [
    ("exposure", "biolink:ChemicalExposure"),
    ("effect/phenotype", "biolink:PhenotypicFeature"),
    ("molecular_function", "biolink:MolecularActivity"),
    ("cellular_component", "biolink:CellularComponent"),
    ("biological_process", "biolink:BiologicalProcess"),
    ("pathway", "biolink:Pathway"),
    ("gene/protein", "biolink:Gene"),
    ("disease", "biolink:Disease"),
    ("drug", "biolink:SmallMolecule"),
    ("anatomy", "biolink:GrossAnatomicalStructure"),
]

# --- fixed values: raw category -> category (None: unknown, skipped) -------------------

RAW_CATEGORIES = {
    "Anatomy": "biolink:GrossAnatomicalStructure",
    "BiologicalProcess": "biolink:BiologicalProcess",
    "CellLine": "biolink:CellLine",
    "CellType": "biolink:Cell",
    "CellularComponent": "biolink:CellularComponent",
    "Complex": "biolink:MacromolecularComplex",
    "Compound": "biolink:SmallMolecule",
    "Cytoband": None,
    "Disease": "biolink:Disease",
    "EC": "biolink:ReactionToCatalystAssociation",
    "Food": "biolink:Food",
    "Gene": "biolink:Gene",
    "Haplotype": "biolink:Haplotype",
    "MiRNA": "biolink:MicroRNA",
    "MolecularFunction": "biolink:MolecularActivity",
    "Organism": "biolink:Bacterium",
    "Pathway": "biolink:Pathway",
    "PharmacologicClass": None,
    "Protein": "biolink:Protein",
    "ProteinDomain": "biolink:ProteinDomain",
    "ProteinFamily": "biolink:ProteinFamily",
    "PwGroup": "biolink:Pathway",
    "Reaction": "biolink:ChemicalToPathwayAssociation",
    "SideEffect": "biolink:DiseaseOrPhenotypicFeature",
    "Symptom": "biolink:DiseaseOrPhenotypicFeature",
    "Variant": "biolink:SequenceVariant",
}

# --- fixed values: one-hot column families ---------------------------------------------

LABEL_FAMILIES = ["CHEBI_ROLE", "MONDO_SUPERCLASS"]

# --- fixed values: data type names used in schema snapshots -----------------------------

TYPE_NAMES = {
    "string": "str",
    "boolean": "bool",
    "tinyint": "i8",
    "smallint": "i16",
    "int": "i32",
    "bigint": "i64",
    "float": "f32",
    "double": "f64",
    "date": "date",
    "binary": "binary",
}
