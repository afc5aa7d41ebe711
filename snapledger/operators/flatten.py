"""Nested JSON to columns: by a declared layout, or recursively along the schema."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ulid_timestamp

TEXTS = "struct<textByDefaultLanguage:string,texts:array<struct<language:struct<isoCode:string>,text:string>>>"
CODED = "struct<code:string,value:string,id:string>"
COUNTRY = "struct<iso2Code:string,name:string,type:string,nonEUMemberState:boolean>"


def snake(name: str) -> str:
    """``basicUdiDiDataUlid`` to ``basic_udi_di_data_ulid``; runs of capitals stay one word."""
    part = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", part).lower()


def _filled(c: Column) -> Column:
    return F.when(c != "", c)


def code_of(c: Column) -> Column:
    """code, value or id of a coded object, the first that is filled."""
    return F.coalesce(_filled(c["code"]), _filled(c["value"]), _filled(c["id"]))


def text_of(c: Column) -> Column:
    """Text in the default language, else in English, else the first."""
    english = F.filter(c["texts"], lambda t: (t["language"]["isoCode"] == "en") & (F.coalesce(t["text"], F.lit("")) != ""))
    return F.coalesce(_filled(c["textByDefaultLanguage"]), F.try_element_at(english, F.lit(1))["text"], F.try_element_at(c["texts"], F.lit(1))["text"])


def first_of(c: Column) -> Column:
    return F.try_element_at(c, F.lit(1))


def list_size(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0)).cast("bigint")


def joined_codes(c: Column, *path: str) -> Column:
    """``|``-joined values at ``path`` of each entry, empty ones skipped; NULL for no list."""
    def get(x: Column) -> Column:
        for p in path:
            x = x[p]
        return x

    return F.when(c.isNotNull(), F.array_join(F.filter(F.transform(c, get), lambda v: F.coalesce(v, F.lit("")) != ""), "|"))


def flatten_columns(schema: T.StructType, prefix: str = "", joiner: str = ".") -> list[tuple[str, Column]]:
    """(name, column) of every leaf: structs become dotted names, lists their JSON text and ``name.__count``."""
    out: list[tuple[str, Column]] = []

    def walk(fields: T.StructType, at: Column | None, name: str) -> None:
        for f in fields.fields:
            c = F.col(f"`{f.name}`") if at is None else at[f.name]
            full = f"{name}{joiner}{f.name}" if name else f.name
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, c, full)
            elif isinstance(f.dataType, T.ArrayType):
                out.extend([(full, F.to_json(c)), (f"{full}{joiner}__count", F.size(c).cast("bigint"))])
            elif isinstance(f.dataType, T.MapType):
                out.append((full, F.to_json(c)))
            else:
                out.append((full, c))

    walk(schema, None, prefix)
    return out


def flatten_recursive(df: DataFrame, joiner: str = ".") -> DataFrame:
    """All leaves of the frame's schema as columns; the schema's width, not the data, sets the plan."""
    return df.select([c.alias(n) for n, c in flatten_columns(df.schema, joiner=joiner)])


def _parsed(body: Column, paths: Sequence[str]) -> dict[str, Column]:
    """The JSON text or value at each path, with one look at the document (and one more at what is wanted whole and in parts)."""
    root: dict = {}
    for path in paths:
        at = root
        for part in re.findall(r"[^.\[\]]+|\[\d+\]", path):
            at = at.setdefault("children", {}).setdefault(part, {})
        at["whole"] = True

    def kind(node: dict) -> str:
        if "children" not in node or "whole" in node:
            return "string"
        parts = {p: kind(c) for p, c in node["children"].items()}
        if all(p.startswith("[") for p in parts):
            return f"array<{next(iter(parts.values()))}>"
        return "struct<" + ", ".join(f"`{p}`:{k}" for p, k in parts.items()) + ">"

    out: dict[str, Column] = {}

    def walk(node: dict, at: Column, path: str) -> None:
        if "whole" in node:
            out[path] = at
            if "children" not in node:
                return
            at = F.from_json(at, kind({"children": node["children"]}))
        for part, child in node["children"].items():
            value = F.get(at, F.lit(int(part[1:-1]))) if part.startswith("[") else at[part]
            walk(child, value, f"{path}{part}" if part.startswith("[") else f"{path}.{part}" if path else part)

    walk(root, F.from_json(body, kind(root)), "")
    return out


def flatten_declared(df: DataFrame, body: str, layout: Sequence[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """Columns of a JSON text column by a layout; what is not in a document is NULL, and so is all of a broken one.

    A layout entry is ``path`` or ``path>column`` with one of the marks after the path: ``#`` the code of
    a coded object, ``@`` a ULID that is followed by its ``_timestamp``, ``$`` the text of a multilingual
    object, ``&`` the JSON text.  The column's default name is the path in snake case.  ``kinds`` gives
    types other than string by path.  A document is parsed once, by a schema made from the layout.
    """
    kinds = kinds or {}
    entries = []
    for entry in layout:
        path, _, name = entry.partition(">")
        mark = path[-1] if path[-1] in "#@$&" else ""
        path = path.rstrip("#@$&")
        entries.append((path, mark, name or snake(path.replace(".", "_")) + ("_json" if mark == "&" else "_code" if mark == "#" else "")))
    found = _parsed(F.col(body), [path for path, _, _ in entries])
    out: list[Column] = []
    for path, mark, name in entries:
        raw = found[path]
        if mark == "#":
            value = F.coalesce(code_of(F.from_json(raw, CODED)), F.when(~raw.startswith("{"), raw))
        elif mark == "$":
            value = F.coalesce(text_of(F.from_json(raw, TEXTS)), F.when(~raw.startswith("{"), raw))
        else:
            value = raw.try_cast(kinds[path]) if path in kinds else raw
        out.append(value.alias(name))
        if mark == "@":
            out.append(F.date_format(ulid_timestamp(raw), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias(f"{name}_timestamp"))
    return df.select(*[c for c in df.columns if c != body], *out, F.col(body).alias("raw_json"))


# The layout of a device list row and of an actor list row.
DEVICE_LIST = (
    "basicUdi primaryDi uuid ulid@ basicUdiDiDataUlid@ riskClass# tradeName manufacturerName manufacturerSrn deviceStatusType#>device_status_code "
    "manufacturerNames& manufacturerStatus# latestVersion versionNumber basicUdiDataUuid basicUdiDataUlid@ basicUdiDataVersionState versionState "
    "deviceName deviceModel lastUpdateDate reference basicUdiDataVersionNumber issuingAgency containerPackageCount mfOrPrSrn applicableLegislation "
    "authorisedRepresentativeSrn authorisedRepresentativeName sterile multiComponent deviceCriterion"
).split()
DEVICE_LIST_KINDS = dict.fromkeys(("latestVersion", "sterile", "multiComponent"), "boolean") | dict.fromkeys(
    ("versionNumber", "basicUdiDataVersionNumber", "containerPackageCount"), "bigint"
)
ACTOR_LIST = (
    "uuid ulid@ registrationUlid@ srn {identifier}>registry_identifier name names& actorType.code actorType.srnCode actorType.category "
    "actorStatus.code actorStatusFromDate roleName countryIso2Code countryName countryType dateOfRegistration electronicMail telephone "
    "geographicalAddress buildingNumber streetName postbox addressComplement postalZone cityName abbreviatedName abbreviatedNames& latestVersion "
    "versionNumber associatedToUser legislationLinks& selectable actorValidated nbStatus"
).split()
ACTOR_LIST_KINDS = dict.fromkeys(("latestVersion", "associatedToUser", "selectable", "actorValidated"), "boolean") | {"versionNumber": "bigint"}

# The groups of an actor's and a device's detail answer; a group's columns carry its name.
ADDRESS = "streetName streetInfoApplicable buildingNumber complement postbox gps postalZone cityName"
ACTOR_DETAIL_GROUPS = {
    ("actorDataPublicView", ""): (
        "uuid ulid@ {identifier}>srn {identifier}>registry_identifier name$ name&>names_json abbreviatedName$ type.code>actor_type_code type.srnCode>actor_type_srn_code "
        "type.category>actor_type_category actorStatus.code actorStatusFromDate country.iso2Code country.name country.type "
        "country.nonEUMemberState>country_non_eu_member_state europeanVatNumberApplicable europeanVatNumber tradeRegister eori telephone electronicMail "
        "website latestVersion versionNumber versionState.code lastUpdateDate lastAccuracyDate competentAuthorityResponsibility latestSubsidiary "
        "validatorUuid validatorSrn validatorName validatorType.code validatorType.srnCode validatorType.category validatorEmail validatorTelephone "
        "regulatoryComplianceResponsibles& accuracyData& organizationIdentificationDocuments& acquisitions& certificates& legislationLinks&"
    ),
    ("actorDataPublicView.actorAddress", ""): ADDRESS.replace("complement", "complement>address_complement"),
    ("actorDataPublicView.validatorAddress", "validator"): ADDRESS.replace("complement", "complement>validator_address_complement") + " country.iso2Code country.name country.type",
    ("actorDataPublicView.authorisedRepresentatives[0]", "authorised_representative"): (
        "authorisedRepresentativeUuid>authorised_representative_uuid authorisedRepresentativeUlid@>authorised_representative_ulid srn name address countryName "
        "startDate endDate terminationDate email telephone mandateStatus.code actorStatus.code actorStatusFromDate versionNumber versionState.code latestVersion lastUpdateDate"
    ),
    ("actorDataPublicView.regulatoryComplianceResponsibles[0]", "primary_prrc"): (
        "firstName familyName electronicMail>primary_prrc_email telephone position geographicalAddress.streetName>primary_prrc_street_name "
        "geographicalAddress.buildingNumber>primary_prrc_building_number geographicalAddress.complement>primary_prrc_address_complement "
        "geographicalAddress.postalZone>primary_prrc_postal_zone geographicalAddress.cityName>primary_prrc_city_name "
        "geographicalAddress.country.iso2Code>primary_prrc_country_iso2_code geographicalAddress.country.name>primary_prrc_country_name"
    ),
    ("", ""): "importers& nonEuManufacturers&",
}
DEVICE_DETAIL_GROUPS = {
    ("primaryDi", "primary_di"): "uuid code issuingAgency# type",
    ("placedOnTheMarket", "placed_on_market"): "iso2Code name type nonEUMemberState>placed_on_market_non_eu_member_state",
    ("deviceStatus", "device_status"): "uuid type#>device_status_code statusDate>device_status_date",
    ("udiPiType", "udi_pi"): "batchNumber serializationNumber manufacturingDate expirationDate softwareIdentification",
    ("marketInfoLink", "market_info_link"): "uuid ulid@ latestVersion versionNumber versionDate",
    ("cndNomenclatures[0]", "primary_cnd"): "uuid code description$ ulid@ status# versionState# versionNumber latestVersion",
    ("", ""): (
        "uuid ulid@ containedItem& secondaryDi& secondaryDiApplicable reference tradeName$ tradeName& tradeNameApplicable additionalDescription$ "
        "additionalDescription& latestVersion versionNumber versionDate lastUpdated versionState# discardedDate newDevice annexXVIApplicable>annex_xvi_applicable "
        "cmrSubstance endocrineDisruptor latex oemApplicable reprocessed singleUse sterile sterilization directMarking directMarkingSameAsUdiDi baseQuantity "
        "unitOfUse clinicalSizeApplicable criticalWarningsApplicable storageApplicable maxNumberOfReuses maxNumberOfReusesApplicable additionalInformationUrl "
        "primaryDi& marketInfoLink& marketInfoLink.msWhereAvailable&>ms_where_available_json udiPiType& cndNomenclatures& cmrSubstances& componentDis& clinicalSizes& "
        "criticalWarnings& storageHandlingConditions& subStatuses& linkedUdiDiView& productDesigner&"
    ),
}


def actor_list(identifier: str) -> list[str]:
    """Layout of an actor list row; ``identifier`` is the JSON key under which the source writes its own identifier."""
    return [e.replace("{identifier}", identifier) for e in ACTOR_LIST]


def actor_detail(identifier: str) -> list[str]:
    """Layout of an actor's detail answer, its own identifier read from the JSON key ``identifier``."""
    return grouped_layout({at: text.replace("{identifier}", identifier) for at, text in ACTOR_DETAIL_GROUPS.items()})


def explode_entries(df: DataFrame, body: str, path: str, entry: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep...`` and the fields of each entry of a JSON list at ``path`` (``$`` is the whole text); no entries, no rows.

    ``entry`` is the type of one, as in ``struct<a:string,b:bigint>``.
    """
    text = F.col(body) if path == "$" else F.get_json_object(F.col(body), path)
    return df.select(*keep, F.explode(F.from_json(text, f"array<{entry}>")).alias("__e")).select(*keep, "__e.*")


def with_path(layout: Sequence[str], names: dict[str, str]) -> list[str]:
    """The layout reading other JSON keys: ``names`` maps a path's last key to the one a source writes.

    Columns keep their names, so that a registry's own name for its identifier, say, is a parameter.
    """
    out = []
    for entry in layout:
        path, _, name = entry.partition(">")
        mark = path[-1] if path[-1] in "#@$&" else ""
        bare = path.rstrip("#@$&")
        head, dot, last = bare.rpartition(".")
        if last in names:
            name = name or snake(bare.replace(".", "_")) + ("_json" if mark == "&" else "_code" if mark == "#" else "")
            out.append(f"{head}{dot}{names[last]}{mark}>{name}")
        else:
            out.append(entry)
    return out


def grouped_layout(groups: dict[tuple[str, str], str]) -> list[str]:
    """Layout entries of groups: each entry's path lies under the group's, its column name after the group's prefix."""
    out = []
    for (base, prefix), text in groups.items():
        for entry in text.split():
            path, _, name = entry.partition(">")
            mark = path[-1] if path[-1] in "#@$&" else ""
            bare = path.rstrip("#@$&")
            if not name:
                name = (f"{prefix}_" if prefix else "") + snake(bare.replace(".", "_")) + ("_json" if mark == "&" else "_code" if mark == "#" else "")
            out.append(f"{base}.{bare}{mark}>{name}" if base else f"{bare}{mark}>{name}")
    return out


def market_countries(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per device and market entry; devices without entries give none."""
    entry = f"array<struct<uuid:string,country:{COUNTRY},startDate:string,endDate:string,new:boolean>>"
    link = F.get_json_object(F.col(body), "$.marketInfoLink")
    rows = df.select(
        *keep, F.get_json_object(F.col(body), "$.uuid").alias("device_uuid"), F.get_json_object(link, "$.uuid").alias("market_info_link_uuid"),
        F.explode(F.from_json(F.get_json_object(link, "$.msWhereAvailable"), entry)).alias("e"),
    )
    return rows.select(
        *keep, "device_uuid", "market_info_link_uuid", F.col("e.uuid").alias("market_country_entry_uuid"), F.col("e.country.name").alias("country_name"),
        F.col("e.country.type").alias("country_type"), F.col("e.country.iso2Code").alias("country_iso2"),
        F.col("e.country.nonEUMemberState").alias("non_eu_member_state"), F.col("e.startDate").alias("start_date"), F.col("e.endDate").alias("end_date"), F.col("e.new").alias("new"),
    )
