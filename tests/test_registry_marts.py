"""Landing files to marts on crafted registry rows."""

import datetime
import hashlib
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import checkdigits as C
from ledgerline.functions import normalize as N
from ledgerline.functions.identity import canonical_name, partner_id
from ledgerline.functions.validate import count_rules, observed_rules
from ledgerline.operators import export as X
from ledgerline.operators import lookups as L
from ledgerline.operators import merge as M
from ledgerline.operators import quality as Q
from ledgerline.operators import versions as V
from ledgerline.plans import marts, specs
from ledgerline.sources import landing as S
from ledgerline.streaming.ingest import ingest_once, stream_files, upsert_once

AS_OF = "2026-01-01"


def line(*fields):
    return ";".join('"' + ("" if f is None else str(f)).replace('"', '""') + '"' for f in fields)


def write(path, lines, name):
    (path / name).write_bytes(("\n".join(lines) + "\n").encode("latin-1"))
    return str(path / name)


def establishment(basico, ordem="0001", matriz="1", status="02", motivo="00", pais=None, cnae="0111301", secondary=None, cep="1005010", uf="SP", municipio="7107"):
    return line(basico, ordem, "91", matriz, "LOJA É", status, "20200101", motivo, None, pais, "20190230", cnae, secondary, "RUA", "X", "1", None, "B", cep, uf, municipio, *[None] * 9)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("landing")
    files = {
        "CNAECSV": [line("0111301", "Arroz"), line("4000000", "Nada")], "MOTICSV": [line("00", "SEM MOTIVO")], "MUNICCSV": [line("7107", "SÃO PAULO")], "NATJUCSV": [line("2062", "LTDA")],
        "PAISCSV": [line("105", "BRASIL")], "QUALSCSV": [line("05", "Administrador")],
        "EMPRECSV": [line("99000001", "COMERCIO A", "2062", "05", "1.234,56", "01", None), line("99000002", "COMERCIO B", "2062", "36", "999.999.999.999,00", "07", None), line("99000003", "OUTRA", "2062", "05", "-5,00", "05", "UNIÃO")],
        "ESTABELE": [
            establishment("99000001", motivo="32", secondary="0111301, 4000000,,0111301"), establishment("99000001", "0002", matriz="2", pais="150"),
            establishment("99000002", status="05", pais="8", cep="00000000", uf="EX", cnae="9999999"), establishment("99000003", cep="ABC", uf=None), establishment("77777777"),
        ],
        "SOCIOCSV": [
            line("99000001", "2", "ALICE  SILVA", "***123456**", "05", "20200101", None, "***000000**", "NINGUEM", "00", "4"), line("99000001", "2", "alice silva", "***123456**", "36", "20200101", "150", None, None, None, "0"),
            line("99000002", "3", None, None, "77", "0", "8", "***111111**", "BOB", "88", "A"),
        ],
        "SIMPLESCSV": [line("99000001", "S", "20200101", "00000000", "N", None, None)],
    }
    out = {}
    for family, lines in files.items():
        out[specs.FAMILIES[family].table] = S.load(spark, write(path, lines, f"K.{family}"), family, AS_OF)
    return out | marts.label_domains(spark) | marts.enriched_domains(spark, out)


def one(df, where):
    rows = df.where(where).collect()
    assert len(rows) == 1
    return rows[0]


def test_load(tables):
    companies = {r["cnpj_basico"]: r for r in tables["empresas"].collect()}
    assert companies["99000001"]["capital_social"] == 1234.56 and companies["99000003"]["capital_social"] is None
    first = one(tables["estabelecimentos"], "cnpj_basico = '99000001' and cnpj_ordem = '0001'")
    assert first["cep"] == "01005010" and first["data_inicio_atividade"] is None and first["data_situacao_cadastral"] == datetime.date(2020, 1, 1)
    assert first["nome_fantasia"] == "LOJA É" and first["identificador_matriz_filial"] == 1
    assert one(tables["estabelecimentos"], "cnpj_basico = '99000002'")["pais"] == "008"
    partners = tables["socios"].collect()
    assert len({r["socio_id"] for r in partners}) == 2  # case, spaces and other columns don't matter
    assert {r["pais"] for r in partners} == {None, "150", "8"} and any(r["cnpj_cpf_do_socio"] == specs.NO_DOCUMENT for r in partners)
    assert tables["socios"].columns == ["socio_id", *specs.FAMILIES["SOCIOCSV"].columns]


def test_detail_mart(tables):
    mart = marts.empresa_detalhe(tables)
    assert len(mart.columns) == 52 and mart.count() == 4
    a = one(mart, "cnpj = '99000001000191'")
    assert (a["municipio_nome"], a["porte_descricao"], a["identificador_matriz_filial_descricao"], a["opcao_pelo_simples"]) == ("SÃO PAULO", "Microempresa", "Matriz", "S")
    assert a["motivo_situacao_cadastral_descricao"].startswith("Inexistente")
    b = one(mart, "cnpj_basico = '99000002'")
    assert (b["porte"], b["porte_descricao"], b["situacao_cadastral_descricao"], b["pais_descricao"], b["qualificacao_responsavel_descricao"]) == ("07", None, "Ativa Não Regular", None, "Gerente-Delegado")
    people = marts.socios_detalhe(tables)
    assert len(people.columns) == 17 and people.count() == tables["socios"].count()
    assert one(people, "pais = '150'")["pais_descricao"] == "JERSEY, ILHA DO CANAL"


def test_flags_and_clean(tables):
    flags = marts.data_quality_flags(tables)
    assert len(flags.columns) == 11 and flags.count() == 4 and marts.dropped_by_flags(tables).first()[0] == 1
    a = one(flags, "cnpj = '99000001000191'")
    assert (a["cep_status"], a["motivo_lookup_missing"], a["motivo_enriched_lookup_missing"], a["pais_lookup_missing"]) == ("valid_shape", True, False, False)
    b = one(flags, "cnpj_basico = '99000002'")
    assert (b["cep_status"], b["is_exterior"], b["pais_enriched_lookup_missing"], b["capital_social_is_suspicious_sentinel"]) == ("zero_sentinel", True, True, True)
    c = one(flags, "cnpj_basico = '99000003'")
    assert (c["cep_status"], c["is_exterior"], c["capital_social_is_suspicious_sentinel"]) == ("malformed", None, None)
    clean = marts.estabelecimentos_clean(tables, flags)
    assert len(clean.columns) == 13 and clean.count() == 4
    assert one(clean, "cnpj_basico = '99000002'")["capital_social_clean"] is None and one(clean, "cnpj_basico = '99000003'")["cep_clean"] is None
    partner = marts.socios_quality_flags(tables)
    assert len(partner.columns) == 12
    masked = one(partner, "representante_is_placeholder")
    assert not masked["qualificacao_representante_lookup_missing"]
    assert one(partner, "faixa_etaria_nao_se_aplica")["qualificacao_socio_enriched_lookup_missing"] is False
    odd = one(partner, "cnpj_basico = '99000002'")
    assert odd["qualificacao_representante_enriched_lookup_missing"] and odd["pais_enriched_lookup_missing"]
    distinct = dict(tables, socios=M.latest_by_key(tables["socios"], ["socio_id"], ["faixa_etaria"]))
    tidy = marts.socios_clean(distinct, marts.socios_quality_flags(distinct))
    assert len(tidy.columns) == 17 and tidy.count() == 2


def test_search_and_counts(spark, tables, tmp_path):
    search = marts.empresas_busca_nome(tables)
    assert len(search.columns) == 14 and {r["razao_social"] for r in search.collect()} == {"COMERCIO A", "OUTRA"}
    counts = marts.empresas_busca_nome_counts(search)
    assert {(r["kind"], r["uf"], r["municipio_codigo"], r["municipio_nome"], r["cnae_fiscal_principal"], r["total"]) for r in counts.where("uf = 'SP'").collect()} == {
        ("uf", "SP", None, None, None, 1), ("uf_municipio", "SP", "7107", "SÃO PAULO", None, 1), ("uf_cnae", "SP", None, None, "0111301", 1)
    }
    assert L.count_of(counts, "uf_municipio", uf="SP", municipio_codigo="7107").first()[0] == 1 and L.count_of(counts, "uf", uf="XX").count() == 0
    X.write_search_layout(search, str(tmp_path / "search"), "uf", "razao_social", ["cnpj_basico"], 2)
    found = L.prefix_search(spark.read.parquet(str(tmp_path / "search")), "razao_social", "COM", ["cnpj_basico", "cnpj_ordem"], 5, lambda d: d.where("uf = 'SP'"))
    assert [r["razao_social"] for r in found.collect()] == ["COMERCIO A"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(razao_social,COM)" in plan and "PartitionFilters: [isnotnull(uf" in plan


def test_explode_and_hierarchy(spark, tables):
    assert sorted(r["cnae_codigo"] for r in marts.cnae_secundaria_exploded(tables).collect()) == ["0111301", "0111301", "4000000"]
    levels = {r["codigo"]: r for r in marts.cnaes_hierarquia(spark, tables).collect()}
    a = levels["0111301"]
    assert (a["secao"], a["divisao"], a["grupo"], a["classe"]) == ("A", "01", "011", "0111-3") and levels["4000000"]["secao"] is None


def test_report(tables):
    orphans = {r["label"]: r["orphans"] for r in Q.orphan_report(tables, marts.REFERENCES).collect()}
    assert orphans["estabelecimentos.motivo_situacao_cadastral"] == 1 and orphans["socios.qualificacao_do_representante_legal"] == 1 and orphans["estabelecimentos.pais"] == 2
    covered = {r["label"]: r for r in Q.enriched_coverage(tables, [r for r in marts.REFERENCES if r.enriched]).collect()}
    assert covered["estabelecimentos.pais"]["enriched_orphans"] == 1 and covered["socios.pais"]["available"]
    bare = {k: v for k, v in tables.items() if not k.endswith("_enriched")}
    assert not any(r["available"] for r in Q.enriched_coverage(bare, [r for r in marts.REFERENCES if r.enriched]).collect())


def test_rules(spark, tmp_path):
    rows = spark.createDataFrame([("99000001", "2062", "05", "1", "01", None), ("9900000a", "20", None, "x", "07", None), (None, None, "05\n", None, "05", None)], "cnpj_basico string, natureza_juridica string, qualificacao_responsavel string, capital_social string, porte string, ente_federativo_responsavel string")
    counts = {r["rule"]: (r["checked"], r["invalid"]) for r in count_rules(rows, S.family_rules("EMPRECSV", AS_OF)).collect()}
    assert counts["cnpj_basico:format"] == (2, 1) and counts["natureza_juridica:format"] == (2, 1) and counts["qualificacao_responsavel:format"] == (2, 1)
    assert counts["porte:format"] == (3, 1) and counts["cnpj_basico:required"] == (3, 1) and counts["qualificacao_responsavel:length"] == (2, 1)
    assert observed_rules(rows, "rules", S.family_rules("EMPRECSV", AS_OF)).count() == 3


def test_layout(spark, tmp_path):
    good = [line(*"abcdefg")] * 2
    columns = specs.FAMILIES["EMPRECSV"].columns
    S.check_layout(S.read_strings(spark, write(tmp_path, good, "good"), columns))
    (tmp_path / "empty").write_text("")
    S.check_layout(S.read_strings(spark, str(tmp_path / "empty"), columns))
    for k, bad in enumerate((line(*"abcdefgh"), line(*"abcdef"))):
        with pytest.raises(S.LayoutDriftError):
            S.check_layout(S.read_strings(spark, write(tmp_path, [bad, *good], f"bad{k}"), columns), first_record_only=True)
        late = S.read_strings(spark, write(tmp_path, [*good, bad], f"late{k}"), columns)
        S.check_layout(late, first_record_only=True)
        with pytest.raises(S.LayoutDriftError):
            S.check_layout(late)
        kept, quarantine = S.read_landing(spark, str(tmp_path / f"late{k}"), "EMPRECSV")
        assert (kept.count(), quarantine.count()) == (2, 1)


def test_columns(spark):
    f = lambda value, fn: spark.createDataFrame([(value,)], "c string").select(fn(F.col("c"))).first()[0]
    assert [f(v, N.locale_decimal) for v in ("1.234.567,89", "5.000,00", "1,2,3")] == ["1234567.89", "5000.00", "1.2,3"]
    assert [f(v, lambda c: N.pad_exact(c, 7, 8)) for v in ("1005010", "01005010", "0", "       0", "0000ABCD", None)] == ["01005010", "01005010", "0", "       0", "0000ABCD", None]
    assert [f(v, lambda c: N.pad_code(c, 3)) for v in ("1", "1234", "-1", "+2", None)] == ["001", "1234", "-01", "+02", None]
    assert [f(v, N.to_date_or_null) for v in ("20230230", "2023-01-01", "202301", " 20230101", "20230101")] == [None] * 4 + [datetime.date(2023, 1, 1)]
    assert [f(v, lambda c: N.date_in_range(N.to_date_or_null(c), AS_OF)) for v in ("18991231", "20260102", "19000101")] == [None, None, datetime.date(1900, 1, 1)]
    assert f("a\u0000b", N.strip_nul) == "ab"


def test_partner_id_parity(spark):
    rows = [("1", "2", "3", "  JOSÉ  Silva ", "20200101"), (None, "2", None, None, None)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in specs.PARTNER_IDENTITY[:2] + ("cnpj_cpf_do_socio", "nome_socio", "data_entrada_sociedade")))
    got = [r[0] for r in df.select(partner_id(df, specs.PARTNER_IDENTITY, "nome_socio", parity=True)).collect()]
    want = [str(uuid.UUID(bytes=hashlib.blake2b("\x1f".join([a or "", b or "", c or "", canonical_name(d), e or ""]).encode(), digest_size=16).digest())) for a, b, c, d, e in rows]
    assert got == want and canonical_name(rows[0][3]) == "josé silva"


def test_published_check_digits(spark):
    rows = [("000000000001", "91"), ("330001670001", "01"), ("003944600058", "87"), ("12ABC34501DE", "35")]
    bad = [("12abc34501DE", "35"), ("00000000000", "91"), ("0000000000-1", "91"), (None, "91"), ("000000000001", None)]
    checked = C.with_digit_check(spark.createDataFrame(rows + bad, "stem string, dv string"), "stem", "dv")
    assert C.digit_tally(checked).first().asDict() == {"total": 9, "valid": 4, "invalid": 5}
    assert {r["expected_dv"] for r in C.invalid_examples(checked, ["stem"]).collect()} == {"<malformed-input>", "91"}


def test_merge(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", "t0", "t0"), (2, "b", "t0", "t0")], "k int, v string, data_criacao string, data_atualizacao string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, month int")
    out = {r["k"]: r for r in M.upsert(old, new, ["k"], ["month"], F.lit("t1")).collect()}
    assert [(out[k]["v"], out[k]["data_criacao"], out[k]["data_atualizacao"]) for k in (1, 2, 3)] == [("a", "t0", "t0"), ("d", "t0", "t1"), ("e", "t1", "t1")]
    path = str(tmp_path / "table")
    for _ in range(2):
        V.replace_load(new, path, ["k"], ["month"])
        assert sorted((r["k"], r["v"]) for r in V.read(spark, path).collect()) == [(2, "d"), (3, "e")]
    V.overwrite(V.read(spark, path).where("k = 3"), path)  # read while it is replaced
    assert V.read(spark, path).count() == 1


def test_export(spark, tmp_path):
    folder = str(tmp_path)
    t = {"a": spark.range(5), "b": spark.range(7)}
    assert X.export_all(t, folder) == ["a", "b"] and X.export_all(t, folder) == []
    (tmp_path / "a.parquet" / "_SUCCESS").unlink()
    assert X.export_all(t, folder) == ["a"]
    X.write_manifest(["a", "b"], folder, spark, "2026-01", "1.0")
    row = spark.read.json(f"{folder}/manifest").first()
    assert (row["totalRows"], row["totalTables"], row["schemaVersion"], row["tables"][1]["rows"]) == (12, 2, "2", 7) and row["totalBytes"] > 0
    X.save_mart(spark.range(4), "mart_of_four")
    X.save_mart(spark.range(3), "mart_of_four")
    assert spark.table("mart_of_four").count() == 3
    spark.sql("drop table mart_of_four")


def test_ledger_and_deliveries(spark):
    files = spark.createDataFrame([("2026-01", "a"), ("2026-02", "b"), ("2026-02", "c")], "directory string, filename string")
    ledger = S.ledger_append(spark.createDataFrame([], "directory string, filename string, processed_at timestamp"), files.where("filename < 'c'"))
    assert S.ledger_append(ledger, files.where("filename < 'c'")).count() == 2
    assert [r["filename"] for r in S.pending_files(files, ledger).collect()] == ["c"]
    assert S.force_reprocess(ledger, "2026-02").count() == 1
    months = files.withColumnRenamed("directory", "source_month")
    assert S.latest_delivery(months) == "2026-02" and S.latest_delivery(months, "2026-01") == "2026-01"
    with pytest.raises(ValueError):
        S.latest_delivery(months, "2025-01")


def test_archives(spark, tmp_path):
    target = tmp_path / "out"
    target.mkdir()
    for k in range(2):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w") as z:
            z.writestr(f"K{k}.EMPRECSV", "x" * 1000)
            z.writestr("in/K.SOCIOCSV", str(k))
            z.writestr("readme.txt", "no")
    paths = spark.createDataFrame([(str(tmp_path / f"{k}.zip"),) for k in range(2)], "path string")
    rows = S.extract_archives(paths, str(target)).collect()
    assert sorted((r["member"], r["bytes"], r["crc_ok"]) for r in rows) == [("K0.EMPRECSV", 1000, True), ("K1.EMPRECSV", 1000, True)] + 2 * [("in/K.SOCIOCSV", 1, True)]
    assert sorted(r["file"] for r in rows) == sorted(str(p) for p in target.rglob("*") if p.is_file())
    same = [r["file"] for r in rows if r["member"] == "in/K.SOCIOCSV"]
    assert sorted(r["value"] for r in spark.read.text(same).collect()) == ["0", "1"]
    again = S.extract_archives(paths.selectExpr("concat('file://', path) as path"), f"file://{target}").where("bytes = 1000").collect()
    assert sorted(r["value"] for r in spark.read.text([r["file"] for r in again]).collect()) == 2 * ["x" * 1000]


def test_broken_archive_member(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("K.EMPRECSV", "abcdefgh" * 50)
    raw = (tmp_path / "b.zip").read_bytes()
    (tmp_path / "b.zip").write_bytes(raw.replace(b"abcdefgh", b"abcdefgX", 1))
    rows = S.extract_archives(spark.createDataFrame([(str(tmp_path / "b.zip"),)], "path string"), str(tmp_path / "out")).collect()
    assert [(r["crc_ok"], r["file"]) for r in rows] == [(False, None)]
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file()]


def test_wide_lookups_are_not_broadcast(spark):
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) as label", "array(id, null) as more")
    hint = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hint(L.small(wide)) and not hint(L.small(wide, size=5_000)) and not hint(L.small(wide, rows=9))
    assert hint(L.small(wide.where("id < 0")))


def test_streams(spark, tmp_path):
    source, out, merged = (str(tmp_path / n) for n in ("in", "out", "merged"))
    spark.range(6).selectExpr("id % 3 as k", "id as v").repartition(2).write.parquet(source)
    schema = spark.read.parquet(source).schema
    for _ in range(2):
        ingest_once(stream_files(spark, source, schema), out, str(tmp_path / "c1"))
        assert spark.read.schema(schema).parquet(out).count() == 6
    upsert_once(stream_files(spark, source, schema, files_per_batch=9), merged, ["k"], ["v"], str(tmp_path / "c2"))
    assert sorted((r["k"], r["v"]) for r in V.read(spark, merged).collect()) == [(0, 3), (1, 4), (2, 5)]
    spark.range(1).selectExpr("id as k", "id + 10 as v").write.mode("append").parquet(source)
    upsert_once(stream_files(spark, source, schema), merged, ["k"], ["v"], str(tmp_path / "c2"))
    assert sorted((r["k"], r["v"]) for r in V.read(spark, merged).collect()) == [(0, 10), (1, 4), (2, 5)]


def test_sample_bounds(spark):
    for bad in (0, -1, 101, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            Q.sample_rows(spark.range(3), bad, 1)
    assert Q.sample_rows(spark.range(3), 100, 1).count() == 3


def test_percent(spark):
    rows = spark.createDataFrame([(1, 3), (0, 0)], "a long, b long").select(Q.percent(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r["p"] for r in rows] == ["33.3333%", "n/a"]


def test_separators_and_composed_letters(spark):
    df = spark.createDataFrame([(1, "a^b]c^ d "), (2, "a||b|c")], "k long, t string")
    parts = lambda sep: [(r["k"], r["x"]) for r in L.explode_delimited(df, ["k"], "t", "x", sep).orderBy("k", "x").collect()]
    assert parts("^") == [(1, "a"), (1, "b]c"), (1, "d"), (2, "a||b|c")]
    assert parts("]") == [(1, "a^b"), (1, "c^ d"), (2, "a||b|c")]
    assert parts("||") == [(1, "a^b]c^ d"), (2, "a"), (2, "b|c")]
    names = spark.createDataFrame([("Jose\u0301  SA\u0303O c\u0327a",), ("Jos\u00e9 S\u00c3O \u00e7a",), (None,)], "n string")
    assert [r[0] for r in names.select(N.canonical_text(F.col("n"))).collect()] == ["jos\u00e9 s\u00e3o \u00e7a", "jos\u00e9 s\u00e3o \u00e7a", ""]
