"""Row types of the streams, as DDL."""

Q = "struct<value:double,unit:string>"

PROVENANCE = (
    "struct<producer_id:string,source_protocol:string,sample_time:timestamp,"
    "ingest_time:timestamp,classification:string,edge_id:string,region_id:string>"
)

WEAR_STATE = f"struct<hours_in_service:{Q},cycles:{Q},remaining_useful_life:{Q},status:string>"

TELEMETRY = f"""
event_id string,
asset struct<asset_id:string,callsign:string,platform_type:string,platform_variant:string,force:string>,
kinematics struct<
  position:struct<valid_at:timestamp,
    ecef:struct<x:{Q},y:{Q},z:{Q}>,
    wgs84:struct<lat:{Q},lon:{Q},alt:{Q}>,
    local_enu:struct<east:{Q},north:{Q},up:{Q}>>,
  velocity:struct<ground_speed:{Q}>,
  attitude:struct<euler:struct<yaw:{Q},pitch:{Q},roll:{Q}>>>,
sustainment struct<
  thermal:struct<component_temperature:{Q},ambient_temperature:{Q}>,
  fluids:struct<fuel_remaining:{Q}>,
  power:struct<bus_voltage:{Q}>,
  consumables:struct<items:map<string,struct<quantity_remaining:double,quantity_capacity:double,nsn:string>>>,
  wear:struct<components:map<string,{WEAR_STATE}>>,
  health:struct<active_fault_codes:array<string>>,
  value_provenance:map<string,struct<origin:string,confidence:double>>>,
provenance {PROVENANCE}
"""

CLOUD_EVENT = "id string, source string, type string, time string, datacontenttype string, data string"

REGISTRY = "asset_id string, edge_id string, region_id string"

CM_STATE = "asset_id string, region_id string, edge_id string, overall_status int, lifecycle int"

LOGISTICS = (
    "status struct<asset_id:string,overall_severity:int,"
    "constraining_factors:array<struct<factor_id:string,severity:int>>>,"
    "provenance struct<region_id:string,edge_id:string>"
)
