"""From the long table of structure files to entry, chain, residue and atom tables.

This composes the normalisation steps: category pivots, residue schemes,
alternative locations, full-length chains, assembly copies and contacts. Every
step is keyed by entry, so entries spread over the cluster and none is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe import sinks
from helixframe.operators import normalize, spatial
from helixframe.session import materialize

# fixed values: item names of the structure file format
MATRIX = {f"m{r}{c}": f"matrix[{r}][{c}]" for r in (1, 2, 3) for c in (1, 2, 3)} | {f"v{r}": f"vector[{r}]" for r in (1, 2, 3)}
ATOM_ITEMS = ["label_asym_id", "pdbx_PDB_model_num", "label_alt_id", "auth_seq_id", "pdbx_PDB_ins_code", "Cartn_x", "Cartn_y", "Cartn_z",
              "occupancy", "B_iso_or_equiv", "label_atom_id", "type_symbol", "label_comp_id", "auth_asym_id"]
CONN_ITEMS = ["conn_type_id", "pdbx_value_order", *(f"ptnr{k}_{item}" for k in (1, 2) for item in ("label_asym_id", "auth_seq_id", "label_atom_id", "label_comp_id")),
              "pdbx_ptnr1_PDB_ins_code", "pdbx_ptnr2_PDB_ins_code"]
BRANCH_ITEMS = ["entity_id", "entity_branch_list_num_1", "entity_branch_list_num_2", "atom_id_1", "atom_id_2", "value_order"]


def entries(long: DataFrame) -> DataFrame:
    """``entry_id, deposition_date, resolution``: the larger of refinement and microscopy resolution."""
    ids = long.select("entry_id").distinct()
    date = normalize.pivot_category(long, "_pdbx_database_status", ["recvd_initial_deposition_date"]).groupBy("entry_id").agg(
        F.min("recvd_initial_deposition_date").alias("_d"))
    parts = [(c, i) for c, i in (("_refine", "ls_d_res_high"), ("_em_3d_reconstruction", "resolution"))]
    for k, (category, item) in enumerate(parts):
        rows = normalize.pivot_category(long, category, [item]).groupBy("entry_id").agg(F.count(item).alias("n"), F.min(item).alias("v"))
        ids = ids.join(rows.select("entry_id", F.when(F.col("n") == 1, F.col("v")).alias(f"_r{k}")), "entry_id", "left")
    return ids.join(date, "entry_id", "left").select("entry_id", F.to_date("_d").alias("deposition_date"), normalize.largest_number(F.col("_r0"), F.col("_r1")).alias("resolution"))


def schemes(long: DataFrame) -> DataFrame:
    """``entry_id, asym_id, entity_id, auth_idx, comp_ids, hetero, res_ord, cif_idx`` of polymer, non-polymer and branched chains.

    ``cif_idx`` is the row's own number, or its place in the chain where it has none.
    """
    whole = None
    for category, number, index in (("_pdbx_poly_seq_scheme", "pdb_seq_num", "seq_id"), ("_pdbx_nonpoly_scheme", "pdb_seq_num", None), ("_pdbx_branch_scheme", "pdb_seq_num", "num")):
        rows = normalize.pivot_category(long, category, ["asym_id", "entity_id", "mon_id", number, "pdb_ins_code", "hetero", *([index] if index else [])])
        place = F.col(index) if index else F.row_number().over(Window.partitionBy("entry_id", "asym_id").orderBy("row_ord")).cast("string")
        rows = rows.select("entry_id", "asym_id", "entity_id", "row_ord", F.col("mon_id").alias("comp_id"), place.alias("cif_idx"),
                           normalize.auth_index(F.col(number), F.col("pdb_ins_code")).alias("auth_idx"), F.coalesce(F.lower("hetero").isin("y", "yes"), F.lit(False)).alias("hetero"))
        whole = rows if whole is None else whole.unionByName(rows)
    whole = normalize.drop_unknown(whole, "comp_id", ["UNL"])
    keys = ["entry_id", "asym_id", "entity_id"]
    first = whole.groupBy(*keys, "auth_idx").agg(F.min_by("cif_idx", "row_ord").alias("cif_idx"))
    return normalize.residue_scheme(whole, keys, "auth_idx", "comp_id", "hetero", "row_ord").join(first, [*keys, "auth_idx"])


def observed_atoms(long: DataFrame) -> DataFrame:
    """Atom rows without hydrogens and unknown residues, numbers cast."""
    rows = normalize.pivot_category(long, "_atom_site", ATOM_ITEMS)
    rows = rows.select(
        "entry_id", "row_ord", F.col("label_asym_id").alias("asym_id"), F.col("pdbx_PDB_model_num").alias("model_id"), F.col("label_alt_id").alias("alt_id"), "auth_seq_id",
        F.col("pdbx_PDB_ins_code").alias("ins_code"), F.col("Cartn_x").alias("x"), F.col("Cartn_y").alias("y"), F.col("Cartn_z").alias("z"), "occupancy",
        F.col("B_iso_or_equiv").alias("b_factor"), F.col("label_atom_id").alias("atom_id"), F.col("type_symbol").alias("element"), F.col("label_comp_id").alias("comp_id"), "auth_asym_id")
    return normalize.atom_sites(normalize.drop_unknown(rows.withColumn("alt_id", F.coalesce("alt_id", F.lit("."))), "comp_id"))


def single_author_chain(atoms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``entry_id, asym_id, auth_asym_id`` of chains with exactly one author id, and those with another number."""
    return normalize.single_value(atoms, ["entry_id", "asym_id"], "auth_asym_id")


def molecule_atoms(atoms: DataFrame, scheme: DataFrame, comp_atoms: DataFrame) -> DataFrame:
    """Full-length chains of every (entry, model, alternative): ``… target, asym_id, res_ord, comp_id, atom_id, x, y, z …``.

    A chain that has atoms in a model gets all atoms of all its residues; the
    unobserved have null coordinates.
    """
    picked = materialize(normalize.resolve_altlocs(atoms, ["entry_id", "model_id"], ["asym_id", "auth_idx", "atom_id"], "alt_id"), "altlocs")
    views = picked.select("entry_id", "asym_id", "model_id", "target").distinct()
    wanted = scheme.join(views, ["entry_id", "asym_id"])
    return normalize.full_length(wanted, comp_atoms, picked, ["entry_id", "asym_id", "model_id", "target"], "auth_idx",
                                 values=("x", "y", "z", "occupancy", "b_factor"), order="row_ord", by=tuple(c for c in ("entry_id",) if c in comp_atoms.columns))


def assemblies(long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``entry_id, assembly_id, asym_id, oper_id`` rows and the operators' matrices."""
    gen = normalize.pivot_category(long, "_pdbx_struct_assembly_gen", ["assembly_id", "oper_expression", "asym_id_list"])
    opers = normalize.pivot_category(long, "_pdbx_struct_oper_list", ["id", *MATRIX.values()])
    opers = opers.select("entry_id", F.col("id").alias("oper_id"), *(F.col(f"`{item}`").alias(n) for n, item in MATRIX.items()))
    return normalize.assembly_rows(gen, ["entry_id", "assembly_id"], "oper_expression", "asym_id_list"), normalize.operator_table(opers, ["entry_id", "oper_id"])


def expand(full: DataFrame, rows: DataFrame, opers: DataFrame, atoms: DataFrame) -> DataFrame:
    """Atoms of every molecule ``mol_key = entry_assembly_model_alt`` with indices.

    An assembly has the alternatives that a chain of it has; a chain without
    one takes its blank atoms (see the alternative step); every chain comes
    once per operator, as ``asym_oper``.
    """
    have = rows.join(atoms.select("entry_id", "asym_id", "model_id", F.col("alt_id").alias("target")).distinct(), ["entry_id", "asym_id"]).select(
        "entry_id", "assembly_id", "model_id", "target").distinct()
    return indexed_copies(full, rows, have, opers)


CHAIN = ["entry_id", "asym_id", "model_id", "target"]


def indexed_copies(full: DataFrame, rows: DataFrame, have: DataFrame, opers: DataFrame) -> DataFrame:
    """Every chain once per operator of an assembly, with ``chain_idx, res_idx, atom_idx`` within the molecule.

    Places within a chain are numbered before it is copied; chains of a molecule
    are put one behind the other by running sums over the chains' sizes, a row
    a copy. So no window ever holds a molecule's atoms, and an atom is shuffled
    before it is copied only.
    """
    by = lambda *c: Window.partitionBy(*CHAIN).orderBy(*c)
    local = materialize(full.withColumns({"_atom": F.row_number().over(by("res_ord", "atom_ord")) - 1, "_res": F.dense_rank().over(by("res_ord")) - 1}), "chains")
    sizes = local.groupBy(*CHAIN).agg(F.count("*").alias("_atoms"), (F.max("_res") + 1).alias("_ress"))
    placed = sizes.join(rows.distinct(), ["entry_id", "asym_id"]).join(have, ["entry_id", "assembly_id", "model_id", "target"], "left_semi")
    placed = placed.withColumns({"mol_key": F.concat_ws("_", "entry_id", "assembly_id", "model_id", "target"), "chain_id": F.concat_ws("_", "asym_id", "oper_id")})
    before = Window.partitionBy("mol_key").orderBy("chain_id").rowsBetween(Window.unboundedPreceding, -1)
    places = placed.select(*CHAIN, "assembly_id", "oper_id", "mol_key", "chain_id", (F.row_number().over(Window.partitionBy("mol_key").orderBy("chain_id")) - 1).alias("chain_idx"),
                           F.coalesce(F.sum("_ress").over(before), F.lit(0)).alias("_r0"), F.coalesce(F.sum("_atoms").over(before), F.lit(0)).alias("_a0"))
    # the operators meet the copies' places, a row a copy, and not the copied atoms
    columns = [*local.columns, *(c for c in places.columns if c not in CHAIN)]
    moved = spatial.moved_points(local.join(places.join(opers, ["entry_id", "oper_id"]), CHAIN), columns)
    return moved.withColumns({"res_idx": (F.col("_r0") + F.col("_res")).cast("int"), "atom_idx": (F.col("_a0") + F.col("_atom")).cast("int")}).drop("_r0", "_a0", "_res", "_atom")


def entity_rows(long: DataFrame) -> DataFrame:
    """``entry_id, entity_id, seq_num, comp_ids, hetero`` of polymer, branched and non-polymer entities."""
    flag = F.coalesce(F.lower("hetero").isin("y", "yes"), F.lit(False)).alias("hetero")
    keys = ["entry_id", "entity_id"]
    poly = normalize.pivot_category(long, "_entity_poly_seq", ["entity_id", "num", "mon_id", "hetero"]).select(*keys, "num", F.col("mon_id").alias("comp_id"), flag, "row_ord")
    branch = normalize.pivot_category(long, "_pdbx_entity_branch_list", ["entity_id", "num", "comp_id", "hetero"]).select(*keys, "num", "comp_id", flag, "row_ord")
    other = normalize.pivot_category(long, "_pdbx_entity_nonpoly", ["entity_id", "comp_id"]).select(*keys, F.lit("1").alias("num"), "comp_id", F.lit(False).alias("hetero"), "row_ord")
    return normalize.entity_residues(poly.unionByName(branch).unionByName(other), keys, "num", "comp_id", "hetero", "row_ord")


def entity_links(long: DataFrame) -> DataFrame:
    """``entry_id, entity_id, num_1, num_2`` of branched entities with atoms, leaving atoms, components and bond; the last row of two numbers counts."""
    items = ["entity_id", "entity_branch_list_num_1", "entity_branch_list_num_2", *(f"{n}_{k}" for n in ("comp_id", "atom_id", "leaving_atom_id") for k in (1, 2)), "value_order"]
    rows = normalize.pivot_category(long, "_pdbx_entity_branch_link", items)
    rest = [i for i in items[1:] if "list_num" not in i]
    last = rows.groupBy("entry_id", "entity_id", F.col("entity_branch_list_num_1").alias("num_1"), F.col("entity_branch_list_num_2").alias("num_2")).agg(F.max_by(F.struct(*rest), "row_ord").alias("_l"))
    return last.select("entry_id", "entity_id", "num_1", "num_2", "_l.*")


def entities(long: DataFrame) -> DataFrame:
    """``entry_id, entity_id, kind, poly_type, entity_type, letters, letters_can, descriptor``.

    A polymer's type and descriptor are its polymer type; a branched entity's
    descriptor is its first; another's is its component. Letters are X, one a
    number, where there is no code.
    """
    base = normalize.pivot_category(long, "_entity", ["id", "type", "pdbx_description"]).select(
        "entry_id", F.col("id").alias("entity_id"), F.col("type").alias("kind"), F.col("pdbx_description").alias("description"))
    code, canonical = normalize.entity_codes(F.col("pdbx_seq_one_letter_code"), F.col("pdbx_seq_one_letter_code_can"))
    poly = normalize.pivot_category(long, "_entity_poly", ["entity_id", "type", "pdbx_seq_one_letter_code", "pdbx_seq_one_letter_code_can"]).select(
        "entry_id", "entity_id", F.col("type").alias("poly_type"), code.alias("_code"), canonical.alias("_can"))
    branch = normalize.pivot_category(long, "_pdbx_entity_branch_descriptor", ["entity_id", "descriptor", "type"]).groupBy("entry_id", "entity_id").agg(F.min_by("descriptor", F.struct("type", "descriptor")).alias("_branch"))
    size = entity_rows(long).groupBy("entry_id", "entity_id").agg(F.count("*").cast("int").alias("_n"), F.min(F.element_at("comp_ids", 1)).alias("_comp"))
    keys = ["entry_id", "entity_id"]
    known = base.join(poly, keys, "full_outer").join(branch, keys, "left").join(size, keys, "left")
    kind = F.coalesce("kind", F.when(F.col("poly_type").isNotNull(), "polymer"))
    crossed = F.when(F.col("_n").isNotNull() & (kind != "water"), F.array_repeat(F.lit("X"), F.col("_n")))
    return known.withColumn("kind", kind).select(
        *keys, "kind", "poly_type", F.coalesce("poly_type", "kind").alias("entity_type"), F.coalesce("_code", crossed).alias("letters"), F.coalesce("_can", crossed).alias("letters_can"),
        F.when(F.col("kind") == "branched", F.coalesce("_branch", F.lit(""))).when(F.col("poly_type").isNotNull(), F.col("poly_type")).otherwise(F.col("_comp")).alias("descriptor"), "description")


def chain_entities(scheme: DataFrame, entity: DataFrame) -> DataFrame:
    """``entry_id, asym_id, entity_id, entity_type, letters, letters_can, descriptor`` of every chain; water has one X a residue."""
    size = scheme.groupBy("entry_id", "asym_id", "entity_id").agg(F.count("*").cast("int").alias("_n"))
    crossed = F.array_repeat(F.lit("X"), F.col("_n"))
    letters = lambda c: F.when(F.col("kind") == "water", crossed).otherwise(F.col(c)).alias(c)
    return size.join(entity, ["entry_id", "entity_id"], "left").select("entry_id", "asym_id", "entity_id", "entity_type", letters("letters"), letters("letters_can"), "descriptor")


# fixed values: item names of a component's atoms in the structure file format
LOCAL_ITEMS = {"element": "type_symbol", "charge": "charge", "aromatic": "pdbx_aromatic_flag", "stereo": "pdbx_stereo_config"}


def entry_components(long: DataFrame, scheme: DataFrame, comp_atoms: DataFrame) -> DataFrame:
    """``entry_id`` and the columns of ``comp_atoms``: the entry's own values over the dictionary's, field by field.

    A component whose number of heavy atoms differs in the entry is the
    dictionary's wholesale; one that only the entry describes is the entry's.
    """
    used = scheme.select("entry_id", F.explode("comp_ids").alias("comp_id")).distinct()
    default = used.join(comp_atoms, "comp_id")
    values = [c for c in LOCAL_ITEMS if c in comp_atoms.columns]
    items = {c: LOCAL_ITEMS[c] for c in values} | {"element": "type_symbol"}
    rows = normalize.pivot_category(long, "_chem_comp_atom", ["comp_id", "atom_id", *dict.fromkeys(items.values())])
    rows = rows.where(~F.coalesce(F.col("type_symbol").isin("H", "D"), F.lit(False)))
    given = lambda c: F.when(~F.col(items[c]).isin("?", "."), F.col(items[c])).alias(c)
    local = rows.select("entry_id", "comp_id", "atom_id", "row_ord", *(given(c) for c in values))
    keys, count = ["entry_id", "comp_id"], lambda df, n: df.groupBy("entry_id", "comp_id").agg(F.count("*").alias(n))
    local = local.join(count(local, "_local"), keys)
    sized = default.join(count(default, "_own"), keys)
    merged = normalize.local_over_default(local, sized, [*keys, "atom_id"], values, ("_local", "_own")).drop("_own")
    alone = local.join(default.select(*keys).distinct(), keys, "left_anti").join(used, keys, "left_semi")
    first = F.min("row_ord").over(Window.partitionBy(*keys))
    types = dict(comp_atoms.dtypes)
    alone = alone.select("entry_id", *((F.col("row_ord") - first).cast(types[c]).alias(c) if c == "atom_ord" else (F.col(c) if c in local.columns else F.lit(None)).cast(types[c]).alias(c) for c in comp_atoms.columns))
    return merged.select("entry_id", *comp_atoms.columns).unionByName(alone)


def connections(long: DataFrame) -> DataFrame:
    """The connection rows between known components, ends as (asym, auth_idx, atom)."""
    rows = normalize.drop_unknown_pairs(normalize.pivot_category(long, "_struct_conn", CONN_ITEMS), "ptnr1_label_comp_id", "ptnr2_label_comp_id")
    end = lambda k, s: [
        F.col(f"ptnr{k}_label_asym_id").alias(f"asym_{s}"), normalize.auth_index(F.col(f"ptnr{k}_auth_seq_id"), F.col(f"pdbx_ptnr{k}_PDB_ins_code")).alias(f"auth_{s}"),
        F.col(f"ptnr{k}_label_atom_id").alias(f"atom_{s}")]
    return rows.select("entry_id", *end(1, "a"), *end(2, "b"), F.col("conn_type_id").alias("conn_type"), F.col("pdbx_value_order").alias("value_order"))


def branch_links(long: DataFrame) -> DataFrame:
    """Links of branched entities as connections between the residues of each of their chains."""
    links = normalize.pivot_category(long, "_pdbx_entity_branch_link", BRANCH_ITEMS)
    places = normalize.pivot_category(long, "_pdbx_branch_scheme", ["asym_id", "entity_id", "num", "pdb_seq_num", "pdb_ins_code"]).select(
        "entry_id", "entity_id", "asym_id", "num", normalize.auth_index(F.col("pdb_seq_num"), F.col("pdb_ins_code")).alias("auth"))
    end = lambda k, s: places.select("entry_id", "entity_id", F.col("asym_id"), F.col("num").alias(f"entity_branch_list_num_{k}"), F.col("auth").alias(f"auth_{s}"))
    joined = links.join(end(1, "a"), ["entry_id", "entity_id", "entity_branch_list_num_1"]).join(end(2, "b"), ["entry_id", "entity_id", "entity_branch_list_num_2", "asym_id"])
    return joined.select("entry_id", F.col("asym_id").alias("asym_a"), "auth_a", F.col("atom_id_1").alias("atom_a"), F.col("asym_id").alias("asym_b"), "auth_b",
                         F.col("atom_id_2").alias("atom_b"), F.lit("branch").alias("conn_type"), "value_order")


def polymer_bonds(atoms: DataFrame, polymer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Residue bonds of neighbours in polymer chains and their backbone atom bonds.

    ``polymer(entry_id, entity_id, protein)`` names the polymer entities.
    """
    residues = atoms.select("entry_id", "mol_key", "chain_idx", "res_idx", "entity_id").distinct().join(polymer, ["entry_id", "entity_id"])
    pairs = normalize.sequence_bonds(residues, ["mol_key", "chain_idx", "protein"], ["res_idx"], "res_idx")
    return pairs.select("mol_key", "src", "dst"), normalize.backbone_bonds(pairs, atoms, ["mol_key"], F.col("protein"))


def build(long: DataFrame, comp_atoms: DataFrame, radius: float = 6.0, most: int = 128, comp_bonds: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of some structure files.

    ``comp_atoms(comp_id, atom_ord, atom_id)`` is the component dictionary's
    heavy atoms and ``comp_bonds(comp_id, atom_id_1, atom_id_2, value_order)``
    its bonds. Entries without assemblies have no molecules. Edges are those of
    neighbours in a polymer, branch links, the file's connections and, between
    atoms, the components' own bonds. The quarantine holds chains with several
    author ids, observed components that the scheme doesn't list or that aren't a
    residue's first, and chains that differ from their entity (water excepted).
    """
    atoms = materialize(observed_atoms(long), "atoms")
    scheme = materialize(schemes(long), "schemes")
    rows, opers = assemblies(long)
    components = materialize(entry_components(long, scheme, comp_atoms), "components")
    whole = materialize(expand(molecule_atoms(atoms, scheme, components), rows, opers, atoms), "molecules")
    entity = materialize(entities(long), "entities")
    polymer = entity.where("poly_type is not null").select("entry_id", "entity_id", F.contains(F.col("poly_type"), F.lit("polypeptide")).alias("protein"))
    next_, backbone = polymer_bonds(whole, polymer)
    linked, bonded = normalize.connection_edges(connections(long).unionByName(branch_links(long)), whole, ["mol_key"])
    plain = lambda df, kind: df.select("mol_key", "src", "dst", F.lit(kind).alias("conn_type"), F.lit(None).cast("string").alias("value_order"))
    residue_edge = plain(next_, "polymer").unionByName(linked)
    atom_edge = plain(backbone.select("mol_key", F.col("src_atom").alias("src"), F.col("dst_atom").alias("dst")), "polymer").unionByName(bonded)
    if comp_bonds is not None:
        own = normalize.component_bond_edges(comp_bonds, whole, ["mol_key"])
        atom_edge = atom_edge.unionByName(own.withColumn("conn_type", F.lit("component")))
    author, clash = single_author_chain(atoms)
    attached = chain_entities(scheme, entity).drop("entity_id")
    chain = whole.select("entry_id", "mol_key", "chain_idx", "chain_id", "asym_id", "oper_id", "entity_id").distinct().join(author, ["entry_id", "asym_id"]).join(attached, ["entry_id", "asym_id"], "left")
    residue = whole.select("mol_key", "chain_idx", "res_idx", "auth_idx", "comp_id", "hetero").distinct()
    contact = spatial.contact_graph(whole, radius, ["mol_key"], "atom_idx", "chain_idx", most=most)
    quarantine = clash.select(F.lit("author chain").alias("stage"), F.concat_ws("_", "entry_id", "asym_id").alias("key"), F.concat("n_values", F.lit(" author ids")).alias("error"))
    strange = normalize.outside_scheme(scheme, atoms, ["entry_id", "asym_id"], "auth_idx").select(
        F.lit("scheme").alias("stage"), F.concat_ws("_", "entry_id", "asym_id", "auth_idx").alias("key"), F.concat("comp_id", F.lit(" is not in the scheme")).alias("error"))
    others = normalize.other_components(scheme, atoms, ["entry_id", "asym_id"], "auth_idx", "row_ord").select(
        F.lit("component").alias("stage"), F.concat_ws("_", "entry_id", "asym_id", "auth_idx").alias("key"), F.concat("comp_id", F.lit(" is not the first observed")).alias("error"))
    kinds = scheme.join(entity.select("entry_id", "entity_id", "kind"), ["entry_id", "entity_id"])
    # an entity that lists no residues can't be held against its chains
    numbers = entity_rows(long)
    unlike = normalize.entity_violations(kinds.join(numbers.select("entry_id", "entity_id").distinct(), ["entry_id", "entity_id"], "left_semi"), numbers,
                                         ["entry_id", "entity_id"], ["entry_id", "asym_id"], F.col("kind") == "water")
    unlike = unlike.select(F.lit("entity").alias("stage"), F.concat_ws("_", "entry_id", "asym_id").alias("key"), F.concat("check", F.lit(" "), "value", F.lit(" is not the entity's")).alias("error"))
    quarantine = quarantine.unionByName(strange).unionByName(others).unionByName(unlike)
    return {"entry": entries(long), "entity": entity, "entity_residue": numbers, "entity_link": entity_links(long), "chain": chain, "residue": residue, "atom": whole,
            "residue_edge": residue_edge, "atom_edge": atom_edge, "chain_contact": contact, "quarantine": quarantine}


# fixed values: columns of the written atom table
WRITTEN = {"type_symbol": "element", "label_atom_id": "atom_id", "label_comp_id": "comp_id", "label_asym_id": "chain_id", "label_entity_id": "entity_id"}


def write_molecules(atoms: DataFrame, path: str) -> None:
    """One structure file a molecule, below folders ``mol_key=...``: its observed atoms, numbered from 1."""
    number = lambda c, form: F.when(F.col(c).isNotNull(), F.format_string(form, F.col(c)))
    missing = lambda c: F.coalesce(c.cast("string"), F.lit("."))
    names = {k: missing(F.col(v)) for k, v in WRITTEN.items() if v in atoms.columns}
    split = F.split("auth_idx", r"\.")
    columns = names | {
        "auth_seq_id": F.element_at(split, 1), "pdbx_PDB_ins_code": F.coalesce(F.try_element_at(split, F.lit(2)), F.lit("?")), "Cartn_x": number("x", "%.3f"), "Cartn_y": number("y", "%.3f"),
        "Cartn_z": number("z", "%.3f"), "occupancy": F.coalesce(number("occupancy", "%.2f"), F.lit("?")), "B_iso_or_equiv": F.coalesce(number("b_factor", "%.2f"), F.lit("?"))}
    lines = sinks.atom_site_lines(atoms, "mol_key", "atom_idx", columns)
    lines.repartition("mol_key").sortWithinPartitions("mol_key", "serial").select("mol_key", F.rtrim("line").alias("line")).write.partitionBy("mol_key").text(path)
