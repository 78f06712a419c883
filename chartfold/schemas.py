"""Pinned schemas.

Reading NDJSON with a fixed schema saves the inference pass over the text and
keeps a query valid when a field happens to be absent from every row. Each
resource lists the fields the library reads, the patient's structs whole; the
readers can add what the data has besides.
"""

CORRUPT = "_corrupt_record"

# The resources loaded when the caller names none.
DEFAULT_RESOURCES = ("Patient", "Condition", "Encounter", "Observation", "MedicationRequest")

_CODING = "array<struct<code:string,display:string>>"
_PERIOD = "struct<start:string,end:string>"
# The whole structs that the master table carries on.
_NAME = (
    "array<struct<use:string,text:string,family:string,given:array<string>,prefix:array<string>,"
    f"suffix:array<string>,period:{_PERIOD}>>"
)
_ADDRESS = (
    "array<struct<use:string,type:string,text:string,line:array<string>,city:string,district:string,"
    f"state:string,postalCode:string,country:string,period:{_PERIOD}>>"
)
_MARITAL = (
    "struct<coding:array<struct<system:string,version:string,code:string,display:string,"
    "userSelected:boolean>>,text:string>"
)
_REFERENCE = "struct<reference:string>"

RESOURCES = {
    "patient": (
        "id string, birthDate string, gender string, "
        f"name {_NAME}, address {_ADDRESS}, maritalStatus {_MARITAL}"
    ),
    "condition": f"id string, subject {_REFERENCE}, code struct<coding:{_CODING}>",
    "medicationrequest": (
        "id string, status string, intent string, authoredOn string, "
        f"medicationCodeableConcept struct<coding:{_CODING}>, "
        f"subject {_REFERENCE}, encounter {_REFERENCE}"
    ),
    "encounter": (
        "id string, status string, class struct<code:string>, "
        f"type array<struct<coding:{_CODING}>>, "
        "period struct<start:string,end:string>, "
        f"subject {_REFERENCE}, serviceProvider {_REFERENCE}"
    ),
    "observation": (
        f"id string, subject {_REFERENCE}, code struct<coding:{_CODING}>, "
        "valueQuantity struct<value:double>, effectiveDateTime string"
    ),
    # One event log mixes several event kinds; their details share one struct
    # in which the fields of the other kinds are null.
    "log": (
        "exportId string, timestamp string, eventId string, "
        "eventDetail struct<exportUrl:string,transactionTime:string,"
        "totalOutputFileCount:bigint,totalDeletedFileCount:bigint,"
        "totalErrorFileCount:bigint,totalManifests:bigint,files:bigint,"
        "resources:bigint,bytes:bigint,attachments:string,duration:bigint>"
    ),
}

# Elements of the lists of the master table.
ITEMS = {
    "conditions": "struct<condition_code:string,condition_name:string>",
    "medications": (
        "struct<medication_id:string,medication_code:string,medication_name:string,"
        "medication_status:string,intent:string,authoredOn:string,encounter_id:string>"
    ),
    "encounters": (
        "struct<encounter_id:string,encounter_status:string,encounter_type_code:string,"
        "encounter_type_name:string,start_date:string,end_date:string,class_code:string,"
        "organization_id:string>"
    ),
}

MASTER = (
    "patient_id string, "
    f"name {_NAME}, address {_ADDRESS}, birthDate string, gender string, maritalStatus {_MARITAL}, "
    f"conditions array<{ITEMS['conditions']}>, condition_count bigint, "
    f"medications array<{ITEMS['medications']}>, medication_count bigint, "
    f"encounters array<{ITEMS['encounters']}>, encounter_count bigint, "
    "page int, list_pages int"
)
