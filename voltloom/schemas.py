"""Column names, struct types and value domains of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and codes that stored data carries.
PHASES = ("l1", "l2", "l3")
QUANTITIES = ("voltage", "active_power_p14", "active_power_p23", "reactive_power_q12", "reactive_power_q34", "thdu", "thdi")
MEASUREMENTS = tuple(f"{q}_{p}" for q in QUANTITIES for p in PHASES)
SERIES_KEYS = ("meter_number", "timestamp", "shard", "dt")
FLAGS = {"OK": 0, "FROZEN": 1, "ZERO": 2, "BELOW_LIMIT": 3, "CORRUPT": 4}
LEVELS = ("raw", "cleaned", "cleaned_and_corrected")
NODE_TYPES = ("LvFeeder", "Cabinet", "DeliveryPoint")
RESULT_PHASES = ("L1", "L2", "L3", "L1,L2", "L1,L3", "L2,L3", "all")
CABLE_TYPES = ("APB", "MAL", "PEX", "PEX ENLEDER", "PEXMAL", "PSP", "U")
PHASE_MATERIALS = ("AL", "CU", "U")
SHARDS = 3


def _struct(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "l": T.LongType(), "d": T.DoubleType(), "b": T.BooleanType(), "t": T.TimestampType(), "y": T.ByteType(), "h": T.ShortType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, _, k in (f.partition(":") for f in spec.split())])


SERIES = _struct("meter_number:s timestamp:t " + " ".join(f"{m}:d" for m in MEASUREMENTS) + " dt:s shard:h")
FLAG_TABLE = _struct("meter_number:s timestamp:t " + " ".join(f"{m}_flag:y" for m in MEASUREMENTS) + " dt:s shard:h")
PHASE_MAP = _struct("meter_number:s l1_maps_to:s l2_maps_to:s l3_maps_to:s")
TOPOLOGY = _struct(
    "secondary_substation:s zip_code_secondary_substation:s transformer:s transformer_capacity:l lv_feeder:s lv_feeder_fuse_size:l "
    "node1:s node2:s cable_id:s cable_type:s cable_length:d phase_size:l phase_material:s cable_capacity:l resistance:d reactance:d"
)
METER_CABINET = _struct("meter_number:l delivery_point_id:l cabinet:s lv_feeder:s has_heat_pump:b has_solar_panel:b capacity_solar_panel:d service_fuse_size:l")
PHASE_MAPPING = _struct("meter_id:l sm_phase:s feeder_id:l feeder_phase:s transformer_id:l transformer_phase:s")
