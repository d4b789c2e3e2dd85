"""A small structure file from text to molecule tables."""

import pytest
from pyspark.sql import functions as F

from helixframe import sinks
from helixframe.operators import normalize, structure
from helixframe.sources import mmcif

HEAD = "data_1TST\n_entry.id 1TST\n_pdbx_database_status.recvd_initial_deposition_date 2020-02-03\n_refine.ls_d_res_high 2.5\n_em_3d_reconstruction.resolution ?\n"
SCHEME = """loop_
_pdbx_poly_seq_scheme.asym_id
_pdbx_poly_seq_scheme.entity_id
_pdbx_poly_seq_scheme.seq_id
_pdbx_poly_seq_scheme.mon_id
_pdbx_poly_seq_scheme.pdb_seq_num
_pdbx_poly_seq_scheme.pdb_ins_code
_pdbx_poly_seq_scheme.hetero
A 1 1 GLY 1 . n
A 1 2 GLY 2 . n
B 1 1 GLY 1 . n
"""
ATOMS = """loop_
_atom_site.label_asym_id
_atom_site.pdbx_PDB_model_num
_atom_site.label_alt_id
_atom_site.auth_seq_id
_atom_site.pdbx_PDB_ins_code
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.occupancy
_atom_site.B_iso_or_equiv
_atom_site.label_atom_id
_atom_site.type_symbol
_atom_site.label_comp_id
_atom_site.auth_asym_id
A 1 . 1 ? 0.0 0.0 0.0 1.0 5.0 N N GLY A
A 1 A 1 ? 1.0 0.0 0.0 0.6 5.0 CA C GLY A
A 1 B 1 ? 2.0 0.0 0.0 0.4 5.0 CA C GLY A
A 1 . 1 ? 9.0 9.0 9.0 1.0 5.0 HA H GLY A
B 1 . 1 ? 0.0 4.0 0.0 1.0 5.0 N N GLY B
"""
ASSEMBLY = """loop_
_pdbx_struct_assembly_gen.assembly_id
_pdbx_struct_assembly_gen.oper_expression
_pdbx_struct_assembly_gen.asym_id_list
1 1,2 A,B
2 1 B
3 (X0)(1) A
loop_
_pdbx_struct_oper_list.id
""" + "".join(f"_pdbx_struct_oper_list.matrix[{r}][{c}]\n" for r in (1, 2, 3) for c in (1, 2, 3)) + "".join(f"_pdbx_struct_oper_list.vector[{r}]\n" for r in (1, 2, 3)) + """1 1 0 0 0 1 0 0 0 1 0 0 0
2 1 0 0 0 1 0 0 0 1 100 0 0
"""


def test_molecules(spark):
    rows = list(mmcif.parse(HEAD + SCHEME + ATOMS + ASSEMBLY))
    long = mmcif.normal_ids(spark.createDataFrame(rows, mmcif.SCHEMA))
    comp = spark.createDataFrame([("GLY", 0, "N"), ("GLY", 1, "CA"), ("GLY", 2, "C")], "comp_id string, atom_ord int, atom_id string")
    t = structure.build(long, comp)
    entry = t["entry"].first()
    assert (entry.entry_id, str(entry.deposition_date), entry.resolution) == ("1tst", "2020-02-03", 2.5)
    atoms = t["atom"].collect()
    keys = {r.mol_key for r in atoms}
    assert keys == {"1tst_1_1_.", "1tst_1_1_A", "1tst_1_1_B", "1tst_2_1_."}
    first = {(r.chain_id, r.auth_idx, r.atom_id): r.x for r in atoms if r.mol_key == "1tst_1_1_B"}
    assert len(first) == 18 and first["A_1", "1", "CA"] == 2.0 and first["A_2", "1", "CA"] == 102.0 and first["A_1", "2", "N"] is None and first["A_1", "1", "C"] is None
    blank = {(r.chain_id, r.auth_idx, r.atom_id): r.x for r in atoms if r.mol_key == "1tst_1_1_."}
    assert blank["A_1", "1", "CA"] is None and blank["A_1", "1", "N"] == 0.0
    one = sorted((r.atom_idx, r.res_idx, r.chain_idx) for r in atoms if r.mol_key == "1tst_1_1_A")
    assert [i for i, _, _ in one] == list(range(18)) and max(r for _, r, _ in one) == 5 and max(c for _, _, c in one) == 3
    touching = {(r.mol_key, r.src, r.dst): r.n for r in t["chain_contact"].collect()}
    assert touching["1tst_1_1_A", 0, 2] == 4 and ("1tst_1_1_A", 0, 1) not in touching
    assert t["chain"].where("mol_key = '1tst_1_1_A'").count() == 4 and t["quarantine"].count() == 0
    assert t["residue_edge"].count() == t["atom_edge"].count() == 0  # no entity says that these chains are polymers
    polymer = spark.createDataFrame([("1tst", "1", True)], "entry_id string, entity_id string, protein boolean")
    residues, backbone = structure.polymer_bonds(t["atom"], polymer)
    assert residues.where("mol_key = '1tst_1_1_A'").count() == 2 and backbone.where(F.col("mol_key") == "1tst_1_1_A").count() == 2


LINKED = """loop_
_entity.id
_entity.type
_entity.pdbx_description
1 polymer small
2 branched sugars
loop_
_entity_poly.entity_id
_entity_poly.type
_entity_poly.pdbx_seq_one_letter_code
1 polypeptide(L) G(MSE)
loop_
_pdbx_entity_branch_descriptor.entity_id
_pdbx_entity_branch_descriptor.descriptor
_pdbx_entity_branch_descriptor.type
2 'b DGlcp' WURCS
2 'a DGlcp' LINUCS
loop_
_pdbx_branch_scheme.asym_id
_pdbx_branch_scheme.entity_id
_pdbx_branch_scheme.mon_id
_pdbx_branch_scheme.num
_pdbx_branch_scheme.pdb_seq_num
_pdbx_branch_scheme.pdb_ins_code
_pdbx_branch_scheme.hetero
C 2 NAG 1 11 . n
C 2 NAG 2 12 . n
_pdbx_entity_branch_link.entity_id 2
_pdbx_entity_branch_link.entity_branch_list_num_1 2
_pdbx_entity_branch_link.entity_branch_list_num_2 1
_pdbx_entity_branch_link.atom_id_1 C1
_pdbx_entity_branch_link.atom_id_2 O4
_pdbx_entity_branch_link.value_order sing
loop_
_struct_conn.conn_type_id
_struct_conn.pdbx_value_order
_struct_conn.ptnr1_label_asym_id
_struct_conn.ptnr1_auth_seq_id
_struct_conn.ptnr1_label_atom_id
_struct_conn.ptnr1_label_comp_id
_struct_conn.ptnr2_label_asym_id
_struct_conn.ptnr2_auth_seq_id
_struct_conn.ptnr2_label_atom_id
_struct_conn.ptnr2_label_comp_id
covale sing A 1 CA GLY B 1 N GLY
covale ? A 1 XX GLY B 1 N GLY
metalc ? A 1 N GLY B 1 N UNL
"""


def test_entities_links_and_connections(spark):
    text = HEAD + SCHEME + ATOMS + "C 1 . 11 ? 8.0 0.0 0.0 1.0 5.0 O4 O NAG C\nB 1 . 1 ? 0.0 4.0 1.0 1.0 5.0 CB C ALA B\n" + ASSEMBLY.replace("1 1,2 A,B", "1 1,2 A,B,C") + LINKED
    long = mmcif.normal_ids(spark.createDataFrame(list(mmcif.parse(text)), mmcif.SCHEMA))
    comp = spark.createDataFrame([("GLY", 0, "N"), ("GLY", 1, "CA"), ("GLY", 2, "C"), ("NAG", 0, "C1"), ("NAG", 1, "O4")], "comp_id string, atom_ord int, atom_id string")
    bonds = spark.createDataFrame([("GLY", "N", "CA", "sing"), ("GLY", "CA", "C", "sing"), ("GLY", "C", "OXT", "sing"), ("NAG", "C1", "O4", "sing")], "comp_id string, atom_id_1 string, atom_id_2 string, value_order string")
    t = structure.build(long, comp, comp_bonds=bonds)
    assert [(r.entity_id, r.kind, r.poly_type, r.letters, r.descriptor) for r in t["entity"].orderBy("entity_id").collect()] == [
        ("1", "polymer", "polypeptide(L)", ["G", "(MSE)"], "polypeptide(L)"), ("2", "branched", None, None, "a DGlcp")]
    names = {r.atom_idx: (r.chain_id, r.auth_idx, r.atom_id) for r in t["atom"].where("mol_key = '1tst_1_1_A'").collect()}
    places = {r.res_idx: (r.chain_id, r.auth_idx) for r in t["atom"].where("mol_key = '1tst_1_1_A'").collect()}
    edges = {(places[r.src], places[r.dst], r.conn_type, r.value_order) for r in t["residue_edge"].where("mol_key = '1tst_1_1_A'").collect()}
    both = lambda f: {x for o in "12" for x in f(o)}
    assert edges == both(lambda o: [
        (("A_" + o, "1"), ("A_" + o, "2"), "polymer", None), (("C_" + o, "12"), ("C_" + o, "11"), "branch", "sing"),
        (("A_" + o, "1"), ("B_" + o, "1"), "covale", "sing"), (("A_" + o, "1"), ("B_" + o, "1"), "covale", "?")])
    bonded = {(names[r.src], names[r.dst], r.conn_type) for r in t["atom_edge"].where("mol_key = '1tst_1_1_A'").collect()}
    glycine = lambda c, n: [((c, n, "N"), (c, n, "CA"), "component"), ((c, n, "CA"), (c, n, "C"), "component")]
    assert bonded == both(lambda o: [
        *glycine("A_" + o, "1"), *glycine("A_" + o, "2"), *glycine("B_" + o, "1"), *(((f"C_{o}", n, "C1"), (f"C_{o}", n, "O4"), "component") for n in ("11", "12")),
        (("A_" + o, "1", "C"), ("A_" + o, "2", "N"), "polymer"), (("C_" + o, "12", "C1"), ("C_" + o, "11", "O4"), "branch"),
        (("A_" + o, "1", "CA"), ("B_" + o, "1", "N"), "covale")])
    assert [(r.stage, r.key, r.error) for r in t["quarantine"].collect()] == [("scheme", "1tst_B_1", "ALA is not in the scheme")]
    lines = sinks.atom_site_lines(t["atom"], "mol_key", "atom_idx", {"label_atom_id": F.col("atom_id"), "Cartn_x": F.format_string("%.3f", F.col("x"))})
    text = [r.line.rstrip() for r in lines.where("mol_key = '1tst_1_1_A'").orderBy("serial").collect()]
    assert text[:7] == ["data_1tst_1_1_A", "#", "loop_", "_atom_site.group_PDB", "_atom_site.id", "_atom_site.label_atom_id", "_atom_site.Cartn_x"] and text[7].split() == ["ATOM", "1", "N", "0.000"]


# microheterogeneity at residue 1 of A: SER is observed first, THR and ALA follow; B's residue isn't the entity's
MIXED = """data_2MIX
loop_
_entity.id
_entity.type
1 polymer
2 water
loop_
_entity_poly.entity_id
_entity_poly.type
_entity_poly.pdbx_seq_one_letter_code
_entity_poly.pdbx_seq_one_letter_code_can
1 polypeptide(L) S(MSE) SM
loop_
_entity_poly_seq.entity_id
_entity_poly_seq.num
_entity_poly_seq.mon_id
_entity_poly_seq.hetero
1 1 THR y
1 1 SER y
1 2 MSE n
loop_
_pdbx_poly_seq_scheme.asym_id
_pdbx_poly_seq_scheme.entity_id
_pdbx_poly_seq_scheme.seq_id
_pdbx_poly_seq_scheme.mon_id
_pdbx_poly_seq_scheme.pdb_seq_num
_pdbx_poly_seq_scheme.pdb_ins_code
_pdbx_poly_seq_scheme.hetero
A 1 1 THR 1 . y
A 1 1 SER 1 . y
A 1 2 MSE 2 . n
B 1 3 GLY 3 . n
loop_
_pdbx_nonpoly_scheme.asym_id
_pdbx_nonpoly_scheme.entity_id
_pdbx_nonpoly_scheme.mon_id
_pdbx_nonpoly_scheme.pdb_seq_num
_pdbx_nonpoly_scheme.pdb_ins_code
W 2 HOH 7 .
W 2 HOH 8 .
loop_
_chem_comp_atom.comp_id
_chem_comp_atom.atom_id
_chem_comp_atom.type_symbol
_chem_comp_atom.charge
SER N N 1
SER OG O ?
SER H H 0
MSE SE Se 2
MSE XX C 0
ODD QQ C 3
loop_
_atom_site.label_asym_id
_atom_site.pdbx_PDB_model_num
_atom_site.label_alt_id
_atom_site.auth_seq_id
_atom_site.pdbx_PDB_ins_code
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.occupancy
_atom_site.B_iso_or_equiv
_atom_site.label_atom_id
_atom_site.type_symbol
_atom_site.label_comp_id
_atom_site.auth_asym_id
A 1 . 1 ? 1.0 0.0 0.0 0.5 5.0 N N SER A
A 1 . 1 ? 2.0 0.0 0.0 0.5 5.0 N N THR A
A 1 . 1 ? 3.0 0.0 0.0 0.5 5.0 N N ALA A
B 1 . 3 A 4.0 9.0 0.0 1.0 5.0 N N GLY B
W 1 . 7 ? 5.0 5.0 5.0 1.0 ? O O HOH W
"""
ONE = "loop_\n_pdbx_struct_assembly_gen.assembly_id\n_pdbx_struct_assembly_gen.oper_expression\n_pdbx_struct_assembly_gen.asym_id_list\n1 1 A,B,W\n" + ASSEMBLY[ASSEMBLY.index("loop_\n_pdbx_struct_oper_list"):]


def test_first_observed_component_and_entity_checks(spark, tmp_path):
    long = mmcif.normal_ids(spark.createDataFrame(list(mmcif.parse(MIXED.replace("3 A 4.0", "3 ? 4.0") + ONE)), mmcif.SCHEMA))
    comp = spark.createDataFrame([("SER", 0, "N", "N", "0"), ("SER", 1, "OG", "O", "0"), ("THR", 0, "N", "N", "0"), ("MSE", 0, "SE", "Se", "0"), ("GLY", 0, "N", "N", "0"), ("HOH", 0, "O", "O", "0")],
                                 "comp_id string, atom_ord int, atom_id string, element string, charge string")
    t = structure.build(long, comp)
    atoms = {(r.chain_id, r.auth_idx, r.comp_id, r.atom_id): (r.x, r.charge) for r in t["atom"].collect()}
    assert atoms == {
        ("A_1", "1", "SER", "N"): (1.0, "1"), ("A_1", "1", "SER", "OG"): (None, "0"),  # the entry's charge where it has one
        ("A_1", "2", "MSE", "SE"): (None, "0"),  # another number of atoms: the dictionary's
        ("B_1", "3", "GLY", "N"): (4.0, "0"), ("W_1", "7", "HOH", "O"): (5.0, "0"), ("W_1", "8", "HOH", "O"): (None, "0")}
    assert {(r.stage, r.key, r.error) for r in t["quarantine"].collect()} == {
        ("component", "2mix_A_1", "THR is not the first observed"), ("scheme", "2mix_A_1", "ALA is not in the scheme"),
        ("entity", "2mix_B", "component GLY is not the entity's"), ("entity", "2mix_B", "number 3 is not the entity's")}
    chains = {r.chain_id: (r.entity_type, r.letters, r.letters_can, r.descriptor) for r in t["chain"].collect()}
    assert chains["A_1"] == ("polypeptide(L)", ["S", "(MSE)"], ["S", "M"], "polypeptide(L)") and chains["W_1"] == ("water", ["X", "X"], ["X", "X"], None)
    assert {(r.entity_id, r.seq_num, tuple(r.comp_ids), r.hetero) for r in t["entity_residue"].collect()} == {("1", "1", ("THR", "SER"), True), ("1", "2", ("MSE",), False)}
    structure.write_molecules(t["atom"], str(tmp_path / "out"))
    back = mmcif.read_mmcif_folder(spark, str(tmp_path / "out"), pattern="*.txt")[0]
    rows = {}
    for r in back.collect():
        rows.setdefault((r.entry_id, r.row_ord), {})[r.item] = r.value
    assert sorted((v["label_asym_id"], v["auth_seq_id"], v["label_comp_id"], v["Cartn_x"], v["occupancy"], v["B_iso_or_equiv"]) for v in rows.values()) == [
        ("A_1", "1", "SER", "1.000", "0.50", "5.00"), ("B_1", "3", "GLY", "4.000", "1.00", "5.00"), ("W_1", "7", "HOH", "5.000", "1.00", "?")]


def test_entity_codes(spark):
    rows = [("AB", "AB"), ("A(MSE)", "AM"), ("A(MSE)\nB", "AM"), ("A(M\nSE)", None), (None, "A"), ("", ""), (None, None)]
    code, canonical = normalize.entity_codes(F.col("a"), F.col("b"))
    got = [(r.x, r.y) for r in spark.createDataFrame(rows, "a string, b string").select(code.alias("x"), canonical.alias("y")).collect()]
    assert got == [(["A", "B"], ["A", "B"]), (["A", "(MSE)"], ["A", "M"]), (["A", "(MSE)", "B"], ["A", "X", "B"]), (["A", "(MSE)"], ["A", "X"]), (None, None), ([], []), (None, None)]


def test_links_of_two_numbers(spark):
    text = MIXED + "".join(f"_pdbx_entity_branch_link.{i} {v}\n" for i, v in (("entity_id", "2"), ("entity_branch_list_num_1", "2"), ("entity_branch_list_num_2", "1"), ("comp_id_1", "NAG"), ("atom_id_1", "C1"), ("value_order", "sing")))
    long = spark.createDataFrame(list(mmcif.parse(text)), mmcif.SCHEMA)
    assert [(r.num_1, r.num_2, r.comp_id_1, r.comp_id_2, r.atom_id_1, r.value_order) for r in structure.entity_links(long).collect()] == [("2", "1", "NAG", None, "C1", "sing")]


def test_files_of_many_blocks_in_pieces(spark, tmp_path):
    import gzip

    blocks = [f"data_B{i}\n_entry.id B{i}\nloop_\n_atom_site.id\n_atom_site.x\n" + "".join(f"{k} {i}.{k}\n" for k in range(i % 5)) for i in range(40)]
    (tmp_path / "all.cif").write_text("# head\n" + "".join(blocks))
    (tmp_path / "one.cif.gz").write_bytes(gzip.compress(b"data_Z\n_entry.id Z\n"))
    want = sorted(r for b in [*blocks, "data_Z\n_entry.id Z\n"] for r in mmcif.parse(b))
    paths = [str(tmp_path / "all.cif"), str(tmp_path / "one.cif.gz")]
    for split in (1, 7, 100, 1 << 20):
        assert sorted(map(tuple, mmcif.read_mmcif(spark, paths, split=split).collect())) == want
    assert mmcif.read_mmcif(spark, paths, split=100).rdd.getNumPartitions() > 10


def test_categories_reach_the_parser(spark, tmp_path):
    # a loop that doesn't fill its last row would raise if the category were not left out at its rows
    (tmp_path / "a.cif").write_text("data_A\n_entry.id A\nloop_\n_x.a\n_x.b\n1 2\n3 4\n")
    frame = mmcif.read_mmcif(spark, [str(tmp_path / "a.cif")])
    for condition, items in (("category = '_x'", {"a", "b"}), ("category in ('_x', '_entry') and item <> 'a'", {"b", "id"}), ("category = '_x' and category = '_entry'", set()), ("entry_id = 'B'", set())):
        found = frame.where(condition)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert {r.item for r in found.collect()} == items
        if condition == "category = '_x'":
            assert "Filter " not in plan
    reader = mmcif._Reader({"paths": "x"})
    rest = list(reader.pushFilters([mmcif.EqualTo(("category",), "_x"), mmcif.EqualTo(("item",), "a"), mmcif.In(("category",), ("_x", "_y"))]))
    assert reader.wanted == {"_x"} and [f.attribute for f in rest] == [("item",)]


def test_stream_of_structure_files(spark, tmp_path):
    import os

    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    folder.mkdir()

    def add(name, time):
        (folder / name).write_text(f"data_{name}\n_entry.id {name}\n")
        os.utime(folder / name, (time, time))

    def run():
        stream = mmcif.stream_mmcif(spark, str(folder)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        stream.awaitTermination()
        return sorted(r.entry_id for r in spark.read.parquet(out).collect())

    add("a.cif", 1000), add("b.cif", 1000)
    assert run() == ["a.cif", "b.cif"]
    add("c.cif", 2000)
    assert run() == ["a.cif", "b.cif", "c.cif"]
    assert run() == ["a.cif", "b.cif", "c.cif"]


def test_rows_of_cells_are_the_long_table(spark):
    """A row a category's row gives the pivots of a row a cell, with a repeated item, two loops and single values too."""
    texts = [("a", "data_a\n_x.id 1\n_x.kind 'a b'\nloop_\n_y.id\n_y.id\n_y.v\n1 2 p\n3 1 'q r'\nloop_\n_y.id\n_y.w\n9 z\n#\n"), ("b", "data_b\nloop_\n_y.id\n_y.v\n1 p 2\nq_1 3\n;r\ns\n;\n"), ("c", "data_c\nloop_\n_y.id\n_y.v\n1\n")]
    df = spark.createDataFrame(texts, "key string, text string")
    long, bad = mmcif.parse_texts(df, "key", "text")
    rows, worse = mmcif.parse_texts(df, "key", "text", rows=True)
    assert rows.columns == ["entry_id", "category", "row_ord", "cells"] and rows.count() == 2 + 3 + 3
    assert bad.collect() == worse.collect() and bad.count() == 1
    for category, items in [("_x", ["id", "kind"]), ("_y", ["id", "v", "w"])]:
        want, got = (sorted(map(tuple, normalize.pivot_category(t, category, items).collect())) for t in (long, rows))
        assert got == want and want


def test_loops_split_at_once_are_read_the_same():
    """Loops of plain values, of quoted ones, and with names and keywords on their lines; rows that don't fill raise."""
    text = "data_A\nloop_\n_c.x\n_c.y\n1 2\n'a b' 3\nloop_\n_d.z\nu_v\nw\n_e.q 7\ndata_B\nloop_\n_c.x\n_c.y\n4 5\n"
    every = [("A", "_c", 0, ["x", "y"], ["1", "2"]), ("A", "_c", 1, ["x", "y"], ["a b", "3"]), ("A", "_d", 0, ["z"], ["u_v"]), ("A", "_d", 1, ["z"], ["w"]),
             ("A", "_e", 0, ["q"], ["7"]), ("B", "_c", 0, ["x", "y"], ["4", "5"])]
    assert list(mmcif.parse_rows(text)) == every
    assert list(mmcif.parse_rows(text, {"_d"})) == every[2:4]
    assert list(mmcif.parse_rows(text.replace("data_B", "# none\ndata_B"))) == every
    with pytest.raises(ValueError, match="1 values too many"):
        list(mmcif.parse_rows(text + "6\n", {"_d"}))


def test_whole_rows_pivot_without_a_shuffle(spark):
    """Rows of one number, from single items and from two loops of a category, are one; the pivot is that of the long table."""
    texts = [("a", "data_A\n_c.x 1\n_c.y 2\nloop_\n_d.p\n_d.q\n1 2\n3 4\nloop_\n_d.p\n_d.r\n9 8\n"), ("b", "data_B\nloop_\n_d.p\n_d.p\n5 6\n"), ("c", "data_C\nloop_\n_d.p\n_d.q\n1\n")]
    frame = spark.createDataFrame(texts, "key string, text string")
    long, _ = mmcif.parse_texts(frame, "key", "text")
    whole, bad = mmcif.parse_texts(frame, "key", "text", rows=True, whole=True)
    assert [r.key for r in bad.collect()] == ["c"]
    for category, items in (("_c", ["x", "y", "z"]), ("_d", ["p", "q", "r"])):
        pivot = normalize.pivot_category(whole, category, items)
        assert sorted(map(tuple, pivot.collect()), key=str) == sorted(map(tuple, normalize.pivot_category(long, category, items).collect()), key=str)
        assert "Exchange" not in pivot._jdf.queryExecution().executedPlan().toString()
