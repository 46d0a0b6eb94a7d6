"""Topics, ports, attribute names and row types."""

from __future__ import annotations

from pyspark.sql import types as T

# Message topics.
TOPICS = """
ATTRIBUTES COMMAND IDRANK TRACKLET TRACKLET_ID TRACKLET_ATTR URL FRAME_ARRAY
REID_FEATURE WEBCAM_LOGIN_PARAM TERM_SIG DETECTION CLASSIFIER FASTER NONE
""".split()

# Input ports and the topic each one reads.
PORTS = {
    "hdfs-video-url-for-pedestrian-tracking": "URL",
    "hdfs-video-url-for-pedestrian-detection": "URL",
    "hdfs-video-url-for-pedestrian-faster": "URL",
    "hdfs-video-url-for-pedestrian-classifier": "URL",
    "video-url-for-cutting": "URL",
    "pedestrian-tracklet-for-attr-recog": "TRACKLET",
    "pedestrian-tracklet-for-reid-feature-extraction": "TRACKLET",
    "pedestrian-tracklet-for-reid-using-attr": "TRACKLET",
    "pedestrian-tracklet-saving": "TRACKLET",
    "pedestrian-attr-for-reid-using-attr": "ATTRIBUTES",
    "pedestrian-attr-saving": "ATTRIBUTES",
    "pedestrian-track-attr-for-reid-using-attr": "TRACKLET_ATTR",
    "pedestrian-reid-feature-saving": "REID_FEATURE",
    "pedestrian-detection-saving": "DETECTION",
    "pedestrian-idrank-saving": "IDRANK",
}

# The attribute columns of an entity.
ATTRS = """
gender_male gender_female gender_other
age_16 age_30 age_45 age_60 age_older_60
weight_very_fat weight_little_fat weight_normal weight_little_thin weight_very_thin
role_client role_uniform
hair_style_null hair_style_long
head_shoulder_black_hair head_shoulder_with_hat head_shoulder_glasses
head_shoulder_sunglasses head_shoulder_scarf head_shoulder_mask
upper_shirt upper_sweater upper_vest upper_tshirt upper_cotton upper_jacket upper_suit
upper_hoodie upper_cotta upper_other
upper_black upper_white upper_gray upper_red upper_green upper_blue upper_silvery
upper_yellow upper_brown upper_purple upper_pink upper_orange upper_mix_color upper_other_color
lower_pants lower_short_pants lower_skirt lower_short_skirt lower_long_skirt lower_one_piece
lower_jean lower_tight_pants
lower_black lower_white lower_gray lower_red lower_green lower_blue lower_silver
lower_yellow lower_brown lower_purple lower_pink lower_orange lower_mix_color lower_other_color
shoes_leather shoes_sport shoes_boot shoes_cloth shoes_shandle shoes_casual shoes_other
shoes_black shoes_white shoes_gray shoes_red shoes_green shoes_blue shoes_silver
shoes_yellow shoes_brown shoes_purple shoes_pink shoes_orange shoes_mix_color shoes_other_color
accessory_backpack accessory_shoulderbag accessory_handbag accessory_waistbag accessory_box
accessory_plasticbag accessory_paperbag accessory_cart accessory_kid accessory_other
action_calling action_armstretching action_chatting action_gathering action_lying
action_crouching action_running action_holdthing action_pushing action_pulling
action_nipthing action_picking action_other
view_angle_left view_angle_right view_angle_front view_angle_back
occlusion_left occlusion_right occlusion_up occlusion_down occlusion_environment
occlusion_accessory occlusion_object occlusion_other
""".split()

# The attributes a score array fills, in the order of its elements.
SCORED = """
gender_female age_16 age_30 age_45 age_older_60
weight_little_fat weight_normal weight_little_thin
role_client role_uniform hair_style_null hair_style_long
head_shoulder_black_hair head_shoulder_with_hat head_shoulder_glasses
upper_shirt upper_sweater upper_vest upper_tshirt upper_cotton upper_jacket upper_suit
upper_hoodie upper_cotta upper_other
lower_pants lower_skirt lower_short_skirt lower_one_piece lower_jean lower_tight_pants
shoes_leather shoes_sport shoes_boot shoes_cloth shoes_casual shoes_other
accessory_backpack accessory_shoulderbag accessory_handbag accessory_box
accessory_plasticbag accessory_paperbag accessory_cart accessory_other
action_calling action_chatting action_gathering action_holdthing action_pushing
action_pulling action_nipthing action_picking action_other
upper_black upper_white upper_gray upper_red upper_green upper_blue upper_silvery
upper_yellow upper_brown upper_purple upper_pink upper_orange upper_mix_color upper_other_color
lower_black lower_white lower_gray lower_red lower_green lower_blue lower_silver
lower_yellow lower_brown lower_purple lower_pink lower_orange lower_mix_color lower_other_color
shoes_black shoes_white shoes_gray shoes_red shoes_green shoes_blue shoes_silver
shoes_yellow shoes_brown shoes_purple shoes_pink shoes_orange shoes_mix_color shoes_other_color
""".split()

BOX = T.StructType([
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
])

# The field names of the one-line JSON header of a stored entity.
HEADER = T.StructType([
    T.StructField("id", T.StructType([
        T.StructField("video-url", T.StringType()),
        T.StructField("serial-number", T.IntegerType()),
    ])),
    T.StructField("tracklet-number", T.IntegerType()),
    T.StructField("run-frame-index", T.IntegerType()),
    T.StructField("bounding-boxes", T.ArrayType(BOX)),
])

# The field names of the JSON line of a stored sample; all values are text.
SAMPLE_LINE = T.StructType([
    T.StructField(name, T.StringType()) for name in ("idx", "x", "y", "width", "height", "data")
])

MESSAGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("task", T.StringType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("serial", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("payload", T.StringType()),
])

ATTRIBUTE_ROW = T.StructType([T.StructField(name, T.FloatType()) for name in ATTRS])

# Result of a detector on one frame.
DETECTIONS = T.ArrayType(T.StructType([
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("score", T.FloatType()),
]))

_INT, _LONG, _TEXT = T.IntegerType(), T.LongType(), T.StringType()


def _row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# The field names of reports and run logs.
PROCESS = _row(index=_INT, pid=_INT, usedGpuMemory=_LONG)

DEVICE = _row(
    index=_INT,
    fanSpeed=_INT,
    utilRate=_INT,
    usedMem=_LONG,
    totalMem=_LONG,
    temp=_INT,
    slowDownTemp=_INT,
    shutdownTemp=_INT,
    powerUsage=_INT,
    powerLimit=_INT,
    infoCount=_INT,
    processNumList=T.ArrayType(_INT),
    processesDevInfosList=T.ArrayType(PROCESS),
)

# One node's own report.
SERVER_REPORT = _row(
    nodeName=_TEXT,
    ip=_TEXT,
    usedMem=_LONG,
    jvmMaxMem=_LONG,
    jvmTotalMem=_LONG,
    physicTotalMem=_LONG,
    procCpuLoad=_INT,
    sysCpuLoad=_INT,
    cpuNum=_INT,
    cpuCore=_INT,
    cpuVirtualNum=_INT,
    deviceCount=_INT,
    devNumList=T.ArrayType(_INT),
    processNumAllList=T.ArrayType(_INT),
    processAllList=T.ArrayType(PROCESS),
    devInfosList=T.ArrayType(DEVICE),
)

# One container, with the devices its process uses.
CONTAINER_REPORT = _row(
    applicationId=_TEXT,
    applicationAttemptId=_TEXT,
    containerId=_TEXT,
    appName=_TEXT,
    state=_TEXT,
    allocatedMemory=_INT,
    allocatedCpu=_INT,
    nodeName=_TEXT,
    pid=_INT,
    indexList=T.ArrayType(_INT),
    usedGpuMemoryList=T.ArrayType(_LONG),
)

# The nodes and applications of a cluster.
CLUSTER_REPORT = _row(
    nodeInfosList=T.ArrayType(
        _row(name=_TEXT, capabilityCpu=_INT, capabilityMemory=_INT, usedCpu=_INT, usedMemory=_INT)
    ),
    applicationInfosList=T.ArrayType(
        _row(
            applicationId=_TEXT,
            appName=_TEXT,
            neededResourceMemory=_INT,
            neededResourceVcore=_INT,
            usedResourceMemory=_INT,
            usedResourceVcore=_INT,
            reservedResourceMemory=_INT,
            reservedResourceVcore=_INT,
            containerInfosList=T.ArrayType(CONTAINER_REPORT),
            containerIdList=T.ArrayType(_TEXT),
        )
    ),
    containerIdAllList=T.ArrayType(_TEXT),
)

# One row of the run log.
RUN = _row(
    taskID=_TEXT,
    videoName=_TEXT,
    type=_TEXT,
    nodeName=_TEXT,
    trackletSize=_INT,
    trackletId=_TEXT,
    gpu=_TEXT,
    nodeName_gpu=_TEXT,
    isMultiGpu=_TEXT,
    startEachTime=_LONG,
    endEachTime=_LONG,
    borrowObjectTime=_LONG,
    end_start=_LONG,
    pid=_LONG,
)
