"""Fixed values of the recording domain."""

# The eight camera positions of a room, in catalogue order.
CAMERAS = (
    "Cart_Center_2",
    "Cart_LT_4",
    "Cart_RT_1",
    "General_3",
    "Monitor",
    "Patient_Monitor",
    "Ventilator_Monitor",
    "Injection_Port",
)

# Cameras that share one timeline. Any other camera is a group of its own.
SYNC_GROUPS = {
    "A": ("Cart_Center_2", "Cart_LT_4", "Cart_RT_1", "General_3"),
    "B": ("Monitor", "Patient_Monitor", "Ventilator_Monitor"),
}

RECORDING_KEY = ("recording_date", "case_no", "camera_name")

MIB = 1024 * 1024
STATUS_THRESHOLD_MB = 200
DELETE_THRESHOLD_MB = 10
PENDING_MIN_MB = 50
CONVERTED_MIN_MB = 1

# Plausible capture times (2015-01-01 to 2030-12-31 UTC) and the longest believable take.
EPOCH_MIN = 1420070400
EPOCH_MAX = 1924905600
MAX_DURATION_SECONDS = 250000

TARGET_FPS = 30
TAIL_SECONDS = 3600

# Extensions of the files that accompany a container.
COMPANION_EXTENSIONS = (".seq.metadata", ".seq.idx", ".xml", ".aud")

# Body keypoints by region.
HEAD = ("Nose", "Left_Eye", "Right_Eye", "Left_Ear", "Right_Ear")
UPPER_BODY = (
    "Left_Shoulder", "Right_Shoulder", "Left_Elbow", "Right_Elbow", "Left_Wrist", "Right_Wrist",
)
LOWER_BODY = ("Left_Hip", "Right_Hip", "Left_Knee", "Right_Knee", "Left_Ankle", "Right_Ankle")
KEYPOINTS = HEAD + UPPER_BODY + LOWER_BODY
TORSO = ("Left_Shoulder", "Right_Shoulder", "Left_Hip", "Right_Hip")
