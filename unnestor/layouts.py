"""Layouts of three of the document databases that ``ENTITIES`` binds.

Their names and types must match the stored documents, so they are fixed
values: written as ``name`` (text) or ``name:type``, one table after another.
The fourth database, like any other, is read from the user's YAML folder
(``Catalog.load_dir``); ``catalog()`` is a starting point to add to.
"""

from __future__ import annotations

from .plans.catalog import Catalog

RECORDS = "array<map<string,string>>"

# Fields of the tables.
_USER = """company:map<string,string> companyID companyRole createdAt email firstName isAdmin:boolean isBlocked:boolean lastName
phone status userID userProfilePics userType invitedByCompanyEmailID invitedByCompanyID invitedByCompanyName"""
_BRAND = """brandID brandLogoURL brandName brandURL contact email nextStepIntroText nextStepSubtitle phone productFootprintDesc
stepNote steps"""
_COMPANY = """ID Industry amlStatus authorisationCode blockReason brands businessType collectionperYear companyID companyType:integer
compemail country countryName createdAt createdBy email employees:integer factoryAddressDiffers:boolean femaleEmployees:integer
geoLat:float geoLong:float isBlocked:boolean joiningApprovedAt kycStatus maleEmployees:integer modifiedAt monthlyCapacity:integer
name phone profile regNumber regNumberParent rejectionReason resubmitReason site tax tier1Email turnover:integer turnoverCurrency
unblockReason userID"""
_CERTIFICATE = """Doc:boolean ID certificateType createdAt description docURL femScore fileHash fileName fileType geoLat:float
geoLong:float issuanceDate issuer licenseID membershipID oekoClass otherCertName owner referenceIssuer source status title
type:integer updatedAt validFromDate validtoDate"""
_ADDRESS = """ID addressStatus city country currentAddress:boolean employees:integer endDate facilityType femaleEmployees:integer
geoLat:float geoLong:float line1 line2 maleEmployees:integer monthlyCapacity:integer monthlyCapacityUnit officeName
position:integer postal sequence:integer startDate state"""
_PICTURE = """ID addressID createdAt createdBy docURL fileHash fileName fileType geoLat:float geoLong:float
isMainPicture:boolean owner sequence:integer source updatedAt"""
_ADMIN = "email firstName lastName mobile phone title"
_CONTACT = "email firstName lastName phone city country line1 line2 postal"
_STEP = """ID agentID approvalRequestedTo clientID compliantAtVerificationDate:boolean cpSupplierID createdAt createdBy
currentlyValidCertificates delegatedCompanyID displayName"""
_EVIDENCE = "createdAt createdBy docUrl fileHash fileName fileType geoLat:float geoLong:float referenceNo rejectionReason status:integer"

# Root, its foreign key, its fields, and per child the field, the
# name after the root's, the kind and the child's own fields.
_TREES = {
    "channel1_user": ("user_id", _USER, [("topBrands", "topbrands", "records", _BRAND)]),
    "channel1_company": ("company_id", _COMPANY, [
        ("categories", "categories", "values", "category:integer"),
        ("productGroups", "productGroups", "values", "productGroup:integer"),
        ("companySubtypes", "companySubtypes", "values", "companySubtype:integer"),
        ("sustainability", "sustainability", "records", _CERTIFICATE),
        ("social", "social", "records", _CERTIFICATE),
        ("officeAddresses", "officeAddresses", "records", _ADDRESS),
        ("factoryAddresses", "factoryAddresses", "records", _ADDRESS),
        ("profilePics", "profilePics", "records", _PICTURE),
        ("topBrands", "topBrands", "records", _BRAND),
        ("admin", "admin", "single", _ADMIN),
        ("contact", "contact", "single", _CONTACT),
    ]),
    "channel1_orderline-steps": ("orderline_steps_id", _STEP, [("evidencePhotos", "evidencePhotos", "records", _EVIDENCE)]),
}
_PARENT_TYPE = {"values": "array<integer>", "records": RECORDS, "single": "struct"}
_KEY = {"values": "id", "records": "nested_id", "single": "id"}


def _fields(text: str) -> list[dict]:
    return [dict(zip(("name", "type"), f.split(":", 1))) for f in text.split()]


def layouts() -> dict[str, dict]:
    """All layouts by key, as they are written in YAML."""
    out: dict[str, dict] = {}
    for root, (foreign, own, children) in _TREES.items():
        held = [{"name": field, "type": _PARENT_TYPE[kind], **({"fields": _fields(text)} if kind == "single" else {})}
                for field, _, kind, text in children]
        out[root] = {
            "table_name": root, "primary_key": "relationship_id",
            "nested_tables": [{"field": field, "target_table": f"{root}_{name}", "foreign_key": foreign} for field, name, _, _ in children],
            "fields": [{"name": "relationship_id", "source_field": "_id"}, *_fields(own), *held],
        }
        for _, name, kind, text in children:
            out[f"{root}_{name}"] = {
                "table_name": f"{root}_{name}", "primary_key": _KEY[kind], "foreign_key": foreign, "is_array": kind != "single",
                "fields": [{"name": _KEY[kind], "generated": True}, {"name": foreign}, *_fields(text)],
            }
    return out


def catalog() -> Catalog:
    return Catalog.from_dict(layouts())
