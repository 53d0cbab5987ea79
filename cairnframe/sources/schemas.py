"""Typed schemas of the catalogue's nested records."""

from __future__ import annotations

REF = "struct<system:string,ref_type:string,external_id:string,url:string,scope:string,notes:string>"
MEASUREMENT = (
    "struct<id:string,lat:double,lon:double,x_1992:double,y_1992:double,elevation_m:double,elevation_datum:string,elevation_source:string,"
    "horizontal_accuracy_m:double,vertical_accuracy_m:double,source:string,source_ref:string,observed_at:string,observed_date:string,"
    "source_date:string,method:string,device:string,tags:array<string>,verification_status:string,verified_by:string,verified_at:string,"
    "notes:string,created_at:string,created_by:string>"
)
ATTACHMENT = "struct<id:string,kind:string,measurement_id:string,path:string,caption:string,date:string,created_at:string,created_by:string>"
BEST = "struct<mode:string,measurement_id:string,reason:string,updated_at:string,updated_by:string>"
ASSIGNMENT = "struct<method:string,assigned_from_measurement_id:string,assigned_prefix:string,prefix_override_reason:string>"
_AUDIT = "notes:string,created_at:string,created_by:string,updated_at:string,updated_by:string"

OBJECT = f"struct<schema_version:int,id:string,category:string,name_local:string,cave_id:string,id_assignment:{ASSIGNMENT},external_refs:array<{REF}>,measurements:array<{MEASUREMENT}>,best_measurement:{BEST},attachments:array<{ATTACHMENT}>,{_AUDIT}>"
CAVE = f"struct<schema_version:int,id:string,name:string,system_name:string,external_refs:array<{REF}>,object_ids:array<string>,{_AUDIT}>"
RELATION = "struct<schema_version:int,id:string,from_object_id:string,to_object_id:string,relation_type:string,notes:string>"

#: Kind of a record: its folder, schema and the lists that an absent key stands for.
KINDS = {
    "object": ("objects", OBJECT, ["external_refs", "measurements", "attachments"]),
    "cave": ("caves", CAVE, ["external_refs", "object_ids"]),
    "relation": ("relations", RELATION, []),
}
