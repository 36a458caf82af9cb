"""Flattening of the finance system's installment documents into columns.

A document is parsed here, once, when it lands: whatever reads titles or cards later reads columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.columns import stripped

# Field names of the documents.
_PARTY = "struct<Nome:string, Inscricao:string>"
ALLOCATION_LINES = (
    "array<struct<Tipo:string, Competencia:string, CentroDeCusto:string, PlanoDeContas:string, Valor:decimal(18,2)>>"
)
TITLE_DOCUMENT = f"""
    ParcelaId string, Tipo string, Vencimento string, Liquidacao string, Status string,
    ValorBruto decimal(14,2), Numero string, Conta string, MeioDePagamento string, Cancelada boolean,
    DadosDoTitulo struct<
        TituloId:string, NumeroDoTitulo:string, Emissao:string, Valor:decimal(18,2), Empresa:{_PARTY},
        ClienteFornecedor:{_PARTY}>,
    Rateio {ALLOCATION_LINES}
"""
CARD_DOCUMENT = f"""
    ParcelaId string, Tipo string, Status string, Vencimento string, Liquidacao string, Modalidade string, Numero string,
    ValorBruto decimal(14,2), ValorLiquido decimal(14,2), Taxa decimal(14,2), Cancelada string,
    DadosDoCartao struct<
        CartaoId:string, DataDaVenda:string, Hora:string, Empresa:{_PARTY}, Adquirente:string, Bandeira:string,
        MeioDeCaptura:string, TotalDeParcelas:string, Cancelado:string, ConciliadoComPDV:string,
        Vendas:array<struct<DataDaVenda:string, HoraDaVenda:string, NSU:string, CodigoAutorizacao:string>>>,
    Rateio {ALLOCATION_LINES}
"""


def _day(c: Column) -> Column:
    """First ten characters as a date; '' is no date."""
    return F.to_date(F.substring(F.nullif(c, F.lit("")), 1, 10))


def _flag(c: Column) -> Column:
    """'true' / 'false' in any case, as text or JSON boolean; anything else is unknown."""
    word = F.lower(c)
    return F.when(word.isin("true", "false"), word == "true")


def _parsed(documents: DataFrame, schema: str, required: Sequence[str]) -> DataFrame:
    """The documents as column ``d``.  One that is cut short, holds a value that its column can't, or lacks a required
    field fails the task that meets it: half a document would land as if the rest were empty."""
    d = documents.withColumn("d", F.from_json("payload", schema, {"mode": "FAILFAST"}))
    for name in required:
        message = F.concat(F.lit(f"document without {name}: "), F.coalesce(F.substring("payload", 1, 200), F.lit("null")))
        # On the whole struct, not on the field: whatever column is read, the check is made.
        d = d.withColumn("d", F.when(F.col(f"d.{name}").isNotNull(), F.col("d")).otherwise(F.raise_error(message)))
    return d


def flatten_titles(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Title installments from their JSON documents (column ``payload``, kept, as are the columns in ``keep``)."""
    d = _parsed(documents, TITLE_DOCUMENT, ("ParcelaId", "Tipo", "Vencimento"))
    title = F.col("d.DadosDoTitulo")
    return d.select(
        F.col("d.ParcelaId").alias("installment_id"),
        F.col("d.Tipo").alias("type"),
        _day(F.col("d.Vencimento")).alias("due_date"),
        _day(F.col("d.Liquidacao")).alias("settled_date"),
        F.col("d.Status").alias("status"),
        F.col("d.ValorBruto").alias("value"),
        stripped(F.coalesce(F.nullif(F.col("d.Numero"), F.lit("")), title["NumeroDoTitulo"])).alias("number"),
        title["ClienteFornecedor"]["Nome"].alias("party_name"),
        title["ClienteFornecedor"]["Inscricao"].alias("party_document"),
        title["Empresa"]["Nome"].alias("company"),
        title["Empresa"]["Inscricao"].alias("company_tax_id"),
        F.col("d.Conta").alias("account"),
        F.col("d.MeioDePagamento").alias("payment_means"),
        F.col("d.Cancelada").alias("cancelled"),
        title["TituloId"].alias("title_id"),
        title["NumeroDoTitulo"].alias("title_number"),
        _day(title["Emissao"]).alias("issue_date"),
        F.trunc(_day(title["Emissao"]), "MM").alias("issue_month"),
        title["Valor"].alias("title_value"),
        F.col("d.Rateio").alias("lines"),
        "payload",
        *keep,
    )


def flatten_cards(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Card installments from their JSON documents (column ``payload``, kept, as are the columns in ``keep``)."""
    d = _parsed(documents, CARD_DOCUMENT, ("ParcelaId",))
    card = F.col("d.DadosDoCartao")
    sale = F.get(card["Vendas"], 0)

    def filled(c: Column) -> Column:
        return F.nullif(c, F.lit(""))

    sold_on = _day(F.coalesce(filled(card["DataDaVenda"]), sale["DataDaVenda"]))
    return d.select(
        F.col("d.ParcelaId").alias("installment_id"),
        F.col("d.Tipo").alias("type"),
        F.col("d.Status").alias("status"),
        card["CartaoId"].alias("card_id"),
        sold_on.alias("sale_date"),
        F.trunc(sold_on, "MM").alias("sale_month"),
        F.coalesce(filled(card["Hora"]), filled(sale["HoraDaVenda"])).alias("sale_time"),
        _day(F.col("d.Vencimento")).alias("due_date"),
        _day(F.col("d.Liquidacao")).alias("settled_date"),
        card["Empresa"]["Nome"].alias("company"),
        card["Empresa"]["Inscricao"].alias("company_tax_id"),
        card["Adquirente"].alias("acquirer"),
        card["Bandeira"].alias("brand"),
        F.col("d.Modalidade").alias("modality"),
        card["MeioDeCaptura"].alias("capture"),
        F.col("d.Numero").try_cast("int").alias("installment"),
        card["TotalDeParcelas"].try_cast("int").alias("installments"),
        F.col("d.ValorBruto").alias("gross_value"),
        F.col("d.ValorLiquido").alias("net_value"),
        F.col("d.Taxa").alias("fee"),
        sale["NSU"].alias("nsu"),
        sale["CodigoAutorizacao"].alias("authorization"),
        (
            F.coalesce(_flag(F.col("d.Cancelada")), F.lit(False))
            | F.coalesce(_flag(card["Cancelado"]), F.lit(False))
        ).alias("cancelled"),
        _flag(card["ConciliadoComPDV"]).alias("reconciled"),
        F.col("d.Rateio").alias("lines"),
        "payload",
        *keep,
    )
