"""Default dictionaries, keyword lists and thresholds.

Every operator takes these as parameters; the values here are the defaults.
"""

from __future__ import annotations

# Chat shorthand and its spelled-out form.
SHORTHAND = {
    "đểu": "kém",
    "sp": "sản phẩm",
    "dt": "điện thoại",
    "đt": "điện thoại",
    "đth": "điện thoại",
    "đt thoại": "điện thoại",
    "sd": "sử dụng",
    "sài": "dùng",
    "xài": "dùng",
    "ko": "không",
    "kh": "không",
    "k": "không",
    "hok": "không",
    "khg": "không",
    "kg": "không",
    "dc": "được",
    "đc": "được",
    "mk": "mình",
    "mn": "mọi người",
    "mng": "mọi người",
    "nv": "nhân viên",
    "nviên": "nhân viên",
    "nvien": "nhân viên",
    "bh": "bảo hành",
    "okie": "ok",
    "oke": "ok",
    "okey": "ok",
    "o kê": "ok",
    "ngon": "tốt",
    "lag": "giật",
    "prm": "pro max",
    "promax": "pro max",
    "ip": "iphone",
    "tks": "cảm ơn",
    "thanks": "cảm ơn",
    "thank": "cảm ơn",
    "ty": "cảm ơn",
    "ad": "admin",
    "qtv": "quản trị viên",
    "tđ": "tổng đài",
    "iu": "yêu",
    "mún": "muốn",
    "bik": "biết",
    "nhỳ": "nhỉ",
    "nhở": "nhỉ",
    "thỳ": "thì",
    "cam": "camera",
    "bin": "pin",
    "màn": "màn hình",
    "màng": "màn hình",
    "hdh": "hệ điều hành",
    "fb": "facebook",
    "mess": "messenger",
    "dè": "rè",
    "nhoè": "nhòe",
    "họp": "hộp",
    "active": "kích hoạt",
    "siu": "siêu",
    "lỏ": "kém",
    "lởm": "kém",
    "cùi": "kém",
    "tệ": "kém",
    "chán": "thất vọng",
    "nhìu": "nhiều",
    "lun": "luôn",
    "j": "gì",
    "z": "vậy",
    "r": "rồi",
    "ib": "nhắn tin",
    "zalo": "zalo",
    "wf": "wifi",
    "wp": "whatsapp",
    "xịn": "cao cấp",
    "pin trau": "pin trâu",
    "zp/a": "bản quốc tế",
    "p/a": "bản quốc tế",
    "dư": "chứ",
    "pv": "phục vụ",
}


def shorthand(shop_names: dict[str, str] | None = None) -> dict[str, str]:
    """The dictionary, plus the shop's own abbreviations (shop specific)."""
    return {**SHORTHAND, **(shop_names or {})}


# Keywords that assign a clause to an aspect.
ASPECT_KEYWORDS = {
    "Battery/Charging": [
        "pin", "sạc", "sac", "dung lượng pin", "pin trâu", "tụt pin",
        "nóng máy khi sạc", "nhanh hết pin", "pin yếu", "sạc nhanh", "sac nhanh",
    ],
    "Performance/OS": [
        "mượt", "lag", "giật", "đơ", "chơi game", "load", "hiệu năng", "chip",
        "ram", "rom", "máy mát", "nóng máy", "loạn màn hình", "treo máy",
        "nhanh", "chậm", "tốc độ",
    ],
    "Camera": [
        "camera", "chụp ảnh", "quay video", "chụp hình", "sắc nét", "net",
        "quay phim", "selfie", "cam trước", "cam sau", "mờ", "xấu", "đẹp",
    ],
    "Design/Build": [
        "thiết kế", "ngoại hình", "màu sắc", "đẹp", "sang trọng", "nhẹ", "nặng",
        "ọp ẹp", "chắc chắn", "dễ xước", "vỡ", "trầy", "viền", "mặt lưng",
    ],
    "Service/Staff": [
        "nhân viên", "tư vấn", "phục vụ", "nhiệt tình", "hỗ trợ", "dễ thương",
        "chu đáo", "giao hàng", "thái độ", "đổi trả", "bảo hành",
    ],
}

# A clause holding one of these terms is not about the aspect.
ASPECT_VETOES = {
    "Performance/OS": ["pin", "sạc", "sac"],
    "Design/Build": ["camera", "chụp", "quay"],
}

# Sentiment cues.
POSITIVE_CUES = [
    "tốt", "mượt", "trâu", "đẹp", "ưng ý", "nhiệt tình", "nhanh", "dễ thương",
    "chu đáo", "ngon", "rất thích", "tuyệt vời", "sang trọng", "sắc nét",
    "hài lòng", "ok", "ổn",
]
NEGATIVE_CUES = [
    "tệ", "chậm", "lag", "giật", "đơ", "nóng", "ọp ẹp", "mờ", "xấu", "lỗi",
    "yếu", "hỏng", "xước", "trầy", "thất vọng", "rè", "loạn", "hơi hao", "rít",
    "chán", "kém",
]

# What ends a clause.
CLAUSE_MARKS = ".,;!?\n"
CLAUSE_WORDS = ["and", "nhưng", "nhung"]

# Classes, holidays, features, segments.
LABEL_NAMES = {0: "negative", 1: "neutral", 2: "positive"}
HOLIDAYS = ["01-01", "04-30", "05-01", "09-02"]
COMMERCIAL_COLUMNS = [
    "Original_Price", "Discounted_Price", "Sales_Volume", "Avg_Star_Rating",
    "Total_Reviews",
]
SEGMENT_FEATURES = [
    "RAM", "ROM", "Battery", "Camera_MP", "Discounted_Price",
    "Avg_Star_Rating", "Total_Reviews",
]
EXPLORE_FEATURES = [
    "RAM", "ROM", "Battery", "Camera_MP", "Discounted_Price", "Original_Price",
    "Sales_Volume", "Avg_Star_Rating", "Total_Reviews",
]
FORECAST_FEATURES = [
    "Discounted_Price", "Discount_Rate", "Avg_Star_Rating", "Sentiment_Score",
    "Day_of_Week", "Is_Weekend", "Is_Holiday", "Sales_Volume_7d_mean",
]
UNIT_TOKENS = ["ram", "rom", "battery", "camera", "mah", "gb", "mp"]
SEGMENTS = {
    "basic": "Điện thoại giá rẻ - Phổ thông cơ bản",
    "mid_strong": "Tầm trung - Cấu hình tốt & Pin khoẻ",
    "mid_saver": "Tầm trung - Tiết kiệm & Đủ dùng",
    "upper_power": "Cận cao cấp - Hiệu năng & Đa năng",
    "upper_design": "Cận cao cấp - Thiết kế & Đủ dùng",
    "premium": "Cao cấp - Siêu phẩm công nghệ",
}
UNDEFINED_SEGMENT = "Không xác định"

# Slots of the synthetic training sentences.
POSITIVE_WORDS = [
    "tốt", "đẹp", "khoẻ", "khỏe", "mượt", "bền", "nhanh", "ngon", "ổn", "ưng",
    "đáng tiền", "đáng", "nét", "sắc nét", "mạnh", "xịn", "rẻ", "hài lòng",
    "ngon lành", "trâu", "êm",
]
NEGATIVE_WORDS = [
    "tệ", "kém", "dở", "chậm", "lag", "hỏng", "lỗi", "đắt", "nóng", "yếu", "xấu",
]
NEGATORS = ["không", "chẳng", "chưa", "ko", "đâu có"]
SUBJECTS = [
    "", "máy ", "sản phẩm ", "pin ", "màn hình ", "camera ", "điện thoại ",
    "máy này ", "con này ", "hàng ",
]
SUFFIXES = [
    "", " lắm", " chút nào", " gì cả", " tí nào", " như mong đợi",
    " như quảng cáo",
]
POSITIVE_CLAUSES = [
    "máy đẹp", "máy tốt", "cấu hình ổn", "camera đẹp", "màn hình đẹp",
    "pin trâu", "máy mượt", "giá rẻ", "thiết kế đẹp", "chụp ảnh nét",
    "hiệu năng tốt", "loa to", "sạc nhanh", "màn hình sắc nét",
    "máy chạy mượt", "pin khoẻ",
]
NEGATIVE_CLAUSES = [
    "pin yếu", "pin tụt nhanh", "hay nóng", "hay lag", "loa nhỏ",
    "chụp ảnh mờ", "mau hết pin", "hơi đắt", "máy nóng", "giật lag",
    "camera mờ", "sạc chậm", "pin không khoẻ", "không bền", "hay đơ",
    "màn hình hơi tối", "cấu hình yếu",
]
CONTRASTS = ["nhưng", "mà", "tuy nhiên", "có điều", "cái tội"]
NEUTRAL_PHRASES = [
    "tạm được", "cũng được", "bình thường", "bình thường thôi", "tạm ổn",
    "ổn trong tầm giá", "không có gì đặc biệt", "dùng tạm ổn",
    "cũng bình thường", "không quá xuất sắc", "đủ dùng", "ở mức trung bình",
    "không tốt cũng không tệ", "cũng tạm", "không có gì nổi bật",
    "dùng ổn trong tầm giá", "tạm chấp nhận được",
    "không xuất sắc nhưng đủ dùng", "ổn không có gì để chê nhiều",
]
NEUTRAL_SUBJECTS = ["", "máy ", "sản phẩm ", "máy này ", "nhìn chung "]
