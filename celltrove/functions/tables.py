"""Label, category and colour tables."""

# Raw label -> canonical label.
CANONICAL = {
    "T": "T_NK",
    "T/NK": "T_NK",
    "NK": "T_NK",
    "B": "B_Plasma",
    "B_blast": "B_Plasma",
    "Proliferating_B_T": "B_Plasma",
    "Plasma": "B_Plasma",
    "B_progenitor": "B_Plasma",
    "Monocyte/Macrophage": "Myeloid",
    "Monocyte/Macrophage/DC": "Myeloid",
    "Macrophage": "Myeloid",
    "DC": "Myeloid",
    "Macrophage/DC": "Myeloid",
    "Neutrophil": "Myeloid",
    "Monocyte/Neutrophil": "Myeloid",
    "Mast": "Myeloid",
    "Myeloid": "Myeloid",
    "Myeloid/Neutrophil": "Myeloid",
    "pDC": "Myeloid",
    "Fibroblast": "Fibroblast_Myofibroblast",
    "Fibroblast/Myofibroblast": "Fibroblast_Myofibroblast",
    "Mesenchymal_stromal_cell": "Fibroblast_Myofibroblast",
    "Myofibroblast": "Fibroblast_Myofibroblast",
    "Perivascular": "Blood_vessel",
    "Smooth_muscle": "Blood_vessel",
    "Pericyte": "Blood_vessel",
    "Myofibroblast/Pericyte": "Blood_vessel",
    "Endothelial": "Blood_vessel",
    "Blood_vessel": "Blood_vessel",
    "Epithelial": "Epithelial",
    "Keratinocyte": "Epithelial",
    "Melanocyte": "Melanocyte",
    "Melanoma": "Melanocyte",
    "Cancer_cell_with_stem_like_properties": "Stem_like",
    "Proliferating_leukemic_blast": "Stem_like",
    "Proliferating_blast": "Stem_like",
    "Cancer_stem_like_cells": "Stem_like",
    "Stem_like_cell": "Stem_like",
    "Glioblastoma_tumor_cell_astrocyte_derived": "Glioblastoma",
    "Erythroid_cell": "Specialized",
    "Osteoclast": "Specialized",
    "Osteoblast": "Specialized",
    "Cardiomyocyte": "Specialized",
    "Adipocyte": "Specialized",
    "Endocrine": "Specialized",
    "Valvular_interstitial_cell": "Specialized",
    "Unknown": "Unknown",
    "ToRemove": "Unknown",
    "Osteoblast/Unknown": "Unknown",
    "Osteoblast/Unknown/Myeloid": "Unknown",
}

# Training schemes, canonical label -> category; a category's index is its place in CATEGORIES.
SCHEMES = {
    "ct_1": {
        "T_NK": "T_NK",
        "B_Plasma": "B_Plasma",
        "Myeloid": "Myeloid",
        "Blood_vessel": "Blood_vessel",
        "Fibroblast_Myofibroblast": "Fibroblast_Myofibroblast",
        "Epithelial": "Epithelial",
        "Specialized": "Specialized",
        "Melanocyte": "Melanocyte",
        "Stem_like": "Dead",
        "Unknown": "Dead",
        "Less10": "Dead",
    },
    "ct_2": {
        "T_NK": "Lymphocyte",
        "B_Plasma": "Lymphocyte",
        "Myeloid": "Myeloid",
        "Blood_vessel": "Blood_vessel",
        "Fibroblast_Myofibroblast": "Fibroblast_Myofibroblast",
        "Epithelial": "Epithelial",
        "Specialized": "Specialized",
        "Melanocyte": "Melanocyte",
        "Stem_like": "Dead",
        "Unknown": "Dead",
        "Less10": "Dead",
    },
    "ct_3": {
        "T_NK": "Immune",
        "B_Plasma": "Immune",
        "Myeloid": "Immune",
        "Blood_vessel": "Stromal",
        "Fibroblast_Myofibroblast": "Stromal",
        "Epithelial": "Epithelial",
        "Specialized": "Other",
        "Melanocyte": "Melanocyte",
        "Stem_like": "Other",
        "Unknown": "Other",
        "Less10": "Other",
    },
}
CATEGORIES = {
    "ct_1": ("T_NK", "B_Plasma", "Myeloid", "Blood_vessel", "Fibroblast_Myofibroblast", "Epithelial", "Specialized", "Melanocyte", "Dead"),
    "ct_2": ("Lymphocyte", "Myeloid", "Blood_vessel", "Fibroblast_Myofibroblast", "Epithelial", "Specialized", "Melanocyte", "Dead"),
    "ct_3": ("Immune", "Stromal", "Epithelial", "Melanocyte", "Other"),
}
# Category colours of the schemes, red, green, blue.
SCHEME_COLORS = {
    "T_NK": (255, 15, 15),
    "B_Plasma": (255, 143, 15),
    "Myeloid": (255, 211, 15),
    "Blood_vessel": (70, 128, 0),
    "Fibroblast_Myofibroblast": (156, 255, 36),
    "Epithelial": (57, 208, 133),
    "Specialized": (69, 237, 255),
    "Melanocyte": (22, 169, 223),
    "Dead": (143, 143, 143),
    "Lymphocyte": (255, 143, 15),
    "Immune": (255, 143, 15),
    "Stromal": (156, 255, 36),
    "Other": (143, 143, 143),
}
# Display colours of canonical labels.
DISPLAY_COLORS = {
    "T_NK": (255, 15, 15),
    "B_Plasma": (255, 143, 15),
    "Myeloid": (255, 211, 15),
    "Blood_vessel": (70, 128, 0),
    "Fibroblast_Myofibroblast": (156, 255, 36),
    "Epithelial": (57, 208, 133),
    "Specialized": (69, 237, 255),
    "Melanocyte": (22, 169, 223),
    "Stem_like": (22, 69, 223),
    "Glioblastoma": (130, 55, 235),
    "Unknown": (0, 0, 0),
    "Less10": (143, 143, 143),
}
# Atlas cell type -> category, category index and colour.
ATLAS = {
    "Malignant": "Neoplastic",
    "T_cell": "LIC",
    "NK_cell": "LIC",
    "B_cell": "LIC",
    "Plasma": "LIC",
    "Plasmablast": "LIC",
    "Myeloid": "MIC",
    "Monocyte": "MIC",
    "Dendritic": "MIC",
    "Macrophage": "MIC",
    "Mast": "MIC",
    "Erythroblast": "MIC",
    "Granulocytes": "MIC",
    "Granulocyte": "MIC",
    "HSC": "MIC",
    "Endothelial": "Connective",
    "Fibroblast": "Connective",
    "Myofibroblast": "Connective",
    "Pericyte": "Connective",
    "Epithelial": "Epithelial",
    "nan": "Unknown",
}
ATLAS_CATEGORIES = ("Neoplastic", "LIC", "MIC", "Connective", "Epithelial", "Unknown")
ATLAS_COLORS = {
    "Neoplastic": (255, 51, 51),
    "LIC": (255, 87, 51),
    "MIC": (51, 255, 87),
    "Connective": (51, 87, 255),
    "Epithelial": (255, 215, 0),
    "Unknown": (128, 128, 128),
}
# Slides that are left out of training, label of cells with few transcripts.
EXCLUDED = ("brain_s0", "bone_marrow_s0", "bone_marrow_s1", "bone_s0")
LOW_LABEL = {"less10_less10_less10": "Less10"}
