"""Fixed code tables of molecule types, residues and atoms, and their lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: polymer / entity type to its one-letter type code
ENTITY_TYPE_CODE = {
    "polypeptide(L)": "P",
    "polypeptide(D)": "Q",
    "polydeoxyribonucleotide": "D",
    "polyribonucleotide": "R",
    "polydeoxyribonucleotide/polyribonucleotide hybrid": "N",
    "branched": "B",
    "non-polymer": "L",
    "unknown": "X",
}

# fixed values: cluster code to its report label
CLUSTER_LABEL = {
    "P": "Protein(L)",
    "Q": "Protein(D)",
    "A": "Antibody",
    "D": "DNA",
    "R": "RNA",
    "N": "DNA/RNA hybrid",
    "B": "Branched",
    "L": "Non-polymer",
    "X": "Unknown",
}

# fixed values: cluster codes of polymers, components of water, unknown residues, hydrogens
POLYMER_CODES = ["P", "Q", "D", "R", "N", "A"]
WATER = ["HOH", "DOD"]
UNKNOWN_RESIDUES = ["UNL", "UNK"]
HYDROGENS = ["H", "D"]

# fixed values: residue letters to profile indices
PROTEIN_LETTERS = "ARNDCQEGHILKMFPSTWYV"
PROTEIN_SPECIAL = {"X": 20, "B": 3, "J": 20, "O": 20, "U": 4, "Z": 6, "-": 31}
RNA_INDEX = {"A": 21, "C": 23, "G": 22, "U": 24, "T": 24, "N": 25, "-": 31}
DNA_INDEX = {"A": 26, "C": 28, "G": 27, "T": 29, "N": 30, "-": 31}
GAP_INDEX, LIGAND_INDEX, PROFILE_BINS = 31, 20, 32

# fixed values: entity letter to index
ENTITY_INDEX = {"A": 0, "P": 1, "Q": 2, "R": 3, "D": 4, "N": 5, "L": 6, "B": 7, "X": 6}

# fixed values: antibody complementarity-determining regions by residue number
CDR_RANGES = {"L1": (24, 34), "L2": (50, 56), "L3": (89, 97), "H1": (26, 32), "H2": (50, 65), "H3": (95, 102)}

# fixed values: chemical element symbols in order of atomic number
ELEMENTS = [
    "H", "He", "Li", "Be", "B", "C", "N", "O", "F", "Ne", "Na", "Mg", "Al", "Si", "P", "S", "Cl", "Ar", "K", "Ca",
    "Sc", "Ti", "V", "Cr", "Mn", "Fe", "Co", "Ni", "Cu", "Zn", "Ga", "Ge", "As", "Se", "Br", "Kr", "Rb", "Sr", "Y",
    "Zr", "Nb", "Mo", "Tc", "Ru", "Rh", "Pd", "Ag", "Cd", "In", "Sn", "Sb", "Te", "I", "Xe", "Cs", "Ba", "La", "Ce",
    "Pr", "Nd", "Pm", "Sm", "Eu", "Gd", "Tb", "Dy", "Ho", "Er", "Tm", "Yb", "Lu", "Hf", "Ta", "W", "Re", "Os", "Ir",
    "Pt", "Au", "Hg", "Tl", "Pb", "Bi", "Po", "At", "Rn", "Fr", "Ra", "Ac", "Th", "Pa", "U", "Np", "Pu", "Am", "Cm",
    "Bk", "Cf", "Es", "Fm", "Md", "No", "Lr", "Rf", "Db", "Sg", "Bh", "Hs", "Mt", "Ds", "Rg", "Cn", "Nh", "Fl", "Mc",
    "Lv", "Ts", "Og",
]


def protein_index() -> dict[str, int]:
    return {c: i for i, c in enumerate(PROTEIN_LETTERS)} | PROTEIN_SPECIAL


def element_index() -> dict[str, int]:
    """Symbols in upper case to 0-based index; X and D follow the elements."""
    return {e.upper(): i for i, e in enumerate(ELEMENTS)} | {"X": len(ELEMENTS), "D": len(ELEMENTS) + 1}


def lookup(table: dict, key: Column, default) -> Column:
    """The table's value of ``key``, ``default`` for null and unknown keys."""
    flat = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.coalesce(F.element_at(flat, key), F.lit(default))


def entity_code(entity_type: Column) -> Column:
    return lookup(ENTITY_TYPE_CODE, entity_type, "X")


def cluster_label(code: Column, merge_ligands: bool = False) -> Column:
    """Report label of a cluster code; unknown codes are Unknown, or Ligand where ligands merge."""
    label = lookup(CLUSTER_LABEL, code, "Unknown")
    if not merge_ligands:
        return label
    return F.when(code.isNull() | code.isin("B", "L", "X") | ~code.isin(*CLUSTER_LABEL), "Ligand").otherwise(label)
