"""Names and defaults that results depend on."""

# Ordered molecular features of a prepared table.
DEFAULT_FEATURES = [
    "MolWt",
    "TPSA",
    "NumRotatableBonds",
    "NumHDonors",
    "NumHAcceptors",
    "NumAromaticRings",
    "LogP",
]

# Id columns passed through to scored output, in this order.
DEFAULT_ID_COLUMNS = ["chembl_id", "molecule_id", "compound_id", "id"]

# Mostly empty columns of a raw activity table.
SPARSE_ACTIVITY_COLUMNS = [
    "upper_value",
    "toid",
    "text_value",
    "standard_upper_value",
    "standard_text_value",
    "molecule_pref_name",
    "data_validity_description",
    "data_validity_comment",
    "assay_variant_mutation",
    "assay_variant_accession",
    "activity_comment",
]

# Activity selection and label edge (nM).
DEFAULT_TARGET = "CHEMBL247"
DEFAULT_STANDARD_TYPE = "IC50"
ACTIVE_BELOW = 1000.0

# Decision thresholds: forest, net, and plain half.
FOREST_THRESHOLD = 0.38
NET_THRESHOLD = 0.35
HALF_THRESHOLD = 0.5

# Split and seed.
TEST_RATIO = 0.2
FOLDS = 3
SEED = 42

# Forest search grid.
FOREST_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [4, 6, 8],
    "minInstancesPerNode": [1, 2],
    "subsamplingRate": [0.7, 1.0],
}

# Net shape and training.
NET_LAYERS = [7, 32, 16, 1]
NET_LEARNING_RATE = 0.01
NET_EPOCHS = 50
NET_BATCH_SIZE = 32
