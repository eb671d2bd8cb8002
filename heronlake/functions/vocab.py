"""Results depend on these word lists, maps and patterns as they stand."""

#: Raw category to group, in order: where no key is equal, the first that contains the raw value or is contained wins.
CATEGORY_GROUPS = {
    "sports": ["the-thao", "thể thao", "bong-da", "xe", "sea-games-32", "asiancup2019"],
    "news": ["thoi-su", "thời sự", "tin-tuc-trong-ngay", "xa-hoi", "xã hội", "tin-moi-nhat", "tin tức"],
    "world": ["the-gioi", "thế giới", "quoc-te", "quốc tế", "asean", "chau-a-tbd", "chau-au", "chau-my", "chau-phi", "trung-dong"],
    "politics": ["chinh-tri", "chính trị", "xay-dung-dang", "xa-luan"],
    "business": ["kinh-doanh", "kinh-te", "kinh doanh", "kinh tế", "kinh-doanh-tai-chinh", "taichinh", "chungkhoan", "tai-chinh-bat-dong-san", "bat-dong-san", "thi-truong"],
    "entertainment": ["giai-tri", "giải trí", "van-hoa", "van-hoa-giai-tri", "van-hoa-van-nghe", "phim", "xuat-ban"],
    "lifestyle": ["doi-song", "đời sống", "gia-dinh", "ban-tre-cuoc-song", "thoi-trang"],
    "law": ["phap-luat", "pháp luật"],
    "education": ["giao-duc", "giáo dục", "giao-duc-du-hoc", "giao-duc-khoa-hoc", "giaoduc"],
    "health": ["suc-khoe", "sức khỏe", "y-te", "yte"],
    "tech": ["cong-nghe", "công nghệ", "hi-tech", "so-hoa", "khoa-hoc", "khoa học", "ai-365"],
    "travel": ["du-lich", "du lịch", "du-lich-xanh"],
    "auto": ["oto-xe-may", "o-to-xe-may"],
    "military": ["quan-su", "quân sự"],
    "home": ["trang-chu", "home", "tin-moi"],
}

#: The same, with the keys that the cleanup stage adds.
CATEGORY_GROUPS_EXTENDED = {
    "sports": ["the-thao", "thể thao", "bong-da", "bóng đá việt nam", "các môn khác", "xe", "sea-games-32", "asiancup2019"],
    "news": ["thoi-su", "thời sự", "tin-tuc-trong-ngay", "xa-hoi", "xã hội", "tin-moi-nhat", "tin tức", "tin nóng", "dân sinh", "bạn đọc", "59s", "video", "đô thị", "giao thông"],
    "world": ["the-gioi", "thế giới", "quoc-te", "quốc tế", "asean", "chau-a-tbd", "chau-au", "chau-my", "chau-phi", "trung-dong"],
    "politics": ["chinh-tri", "chính trị", "xay-dung-dang", "xa-luan", "chính quyền", "đảng"],
    "business": ["kinh-doanh", "kinh-te", "kinh doanh", "kinh tế", "kinh-doanh-tai-chinh", "taichinh", "tài chính", "chungkhoan", "chứng khoán", "tai-chinh-bat-dong-san", "bat-dong-san", "bất động sản", "thi-truong", "thị trường", "tiền tệ & đầu tư", "đầu tư", "tư vấn tài chính", "net zero", "lao động"],
    "entertainment": ["giai-tri", "giải trí", "van-hoa", "văn hóa", "văn hóa - văn nghệ", "van-hoa-giai-tri", "van-hoa-van-nghe", "phim", "xuat-ban", "xuất bản", "nghệ sĩ", "chân dung"],
    "lifestyle": ["doi-song", "đời sống", "gia-dinh", "gia đình", "ban-tre-cuoc-song", "thoi-trang", "thời trang", "giới trẻ", "góc phụ huynh"],
    "law": ["phap-luat", "pháp luật"],
    "education": ["giao-duc", "giáo dục", "giao-duc-du-hoc", "giao-duc-khoa-hoc", "giaoduc", "nhà trường", "tuyển sinh", "du học"],
    "health": ["suc-khoe", "sức khỏe", "y-te", "yte", "dinh dưỡng"],
    "tech": ["cong-nghe", "công nghệ", "hi-tech", "so-hoa", "khoa-hoc", "khoa học", "ai-365", "ai contest"],
    "travel": ["du-lich", "du lịch", "du-lich-xanh"],
    "auto": ["oto-xe-may", "o-to-xe-may"],
    "military": ["quan-su", "quân sự"],
    "environment": ["môi trường", "moi-truong"],
    "other": ["trắc nghiệm", "trac-nghiem", "lao động cuối tuần"],
    "home": ["trang-chu", "home", "tin-moi"],
}

#: Domain to the name of its source, in order.
SOURCES = {
    "vnexpress.net": "vnexpress", "dantri.com.vn": "dantri", "tuoitre.vn": "tuoitre", "thanhnien.vn": "thanhnien",
    "vietnamnet.vn": "vietnamnet", "laodong.vn": "laodong", "nld.com.vn": "nld", "vietnamplus.vn": "vietnamplus",
    "soha.vn": "soha", "nhandan.vn": "nhandan", "baotintuc.vn": "baotintuc", "kienthuc.net.vn": "kienthuc",
    "znews.vn": "znews", "24h.com.vn": "24h",
}

#: Authors that are names of a source.
SOURCE_NAMES = ["znews", "vnexpress", "dantri", "tuoitre", "thanhnien", "nld", "soha", "nhandan", "vietnamnet", "vietnamplus", "baotintuc", "kienthuc", "laodong", "24h", "zingnews", "rss_feed"]
BRANDS = ["RSS_Feed", "24h", "ZNews", "LaoDong", "VnExpress", "DanTri", "TuoiTre", "ThanhNien", "VietnamNet", "NLD", "VietnamPlus", "Soha", "NhanDan", "BaoTinTuc", "KienThuc"]

#: Boilerplate of articles, removed in this order; . matches line ends, case doesn't count.
BOILERPLATE = [r"^Lưu bài viết thành công.*?Tin bài đã lưu", r"Nguồn:\s*\[Link nguồn\].*$", r"^\(Dân trí\)\s*-\s*", r"^TTO\s*-\s*", r"^TTXVN\s*-\s*"]

#: Words that are no entity and no keyword.
COMMON_WORDS = [
    "bộ", "điểm", "người", "năm", "tuần", "tháng", "ngày", "giờ", "phút", "bên", "phía", "chiều", "sáng", "tối",
    "trưa", "đêm", "ông", "bà", "anh", "chị", "em", "cô", "chú", "bác", "ta", "mình", "họ", "chúng", "nhau", "đây",
    "đó", "kia", "này", "ấy", "trên", "dưới", "trong", "ngoài", "giữa", "nhà", "cửa", "đường", "phố",
]

#: Prefixes of places; the first in this order that fits is cut off.
PLACE_PREFIXES = [
    "xã ", "phường ", "thị trấn ", "thị xã ", "huyện ", "quận ", "thành phố ", "tỉnh ", "tp ", "tp. ", "tp.", "t.p ",
    "khu phố ", "ấp ", "thôn ", "bản ", "làng ", "khu ", "khu vực ", "phía bắc ", "phía nam ", "phía đông ", "phía tây ",
    "miền bắc ", "miền nam ", "miền trung ", "miền tây ", "vùng ",
]
#: Titles of persons; the first in this order that fits is cut off.
PERSON_PREFIXES = [
    "ông ", "bà ", "anh ", "chị ", "em ", "tổng thống ", "thủ tướng ", "chủ tịch ", "bộ trưởng ", "giáo sư ", "tiến sĩ ",
    "thạc sĩ ", "bác sĩ ", "kỹ sư ", "ts. ", "ths. ", "bs. ", "ks. ", "pgs. ", "hlv ", "huấn luyện viên ", "ca sĩ ",
    "nghệ sĩ ", "diễn viên ",
]

#: Keywords that only name a category or a section.
CATEGORY_KEYWORDS = [
    "thế giới", "xã hội", "kinh tế", "thể thao", "chính trị", "thời sự", "giáo dục", "công nghệ", "đời sống", "pháp luật",
    "sức khỏe", "giải trí", "du lịch", "quân sự", "kinh doanh", "văn hóa", "khoa học", "y tế", "ô tô xe máy", "bất động sản",
    "tài chính", "chứng khoán", "thị trường", "gia đình", "âm nhạc", "điện ảnh", "thời trang", "ẩm thực", "nhà đất", "ô tô",
    "xe máy", "thị trường - tiêu dùng", "tài chính - bất động sản",
    "news", "world", "sports", "business", "tech", "politics", "entertainment", "lifestyle", "law", "education", "health",
    "travel", "auto", "military", "home",
    "the-gioi", "xa-hoi", "kinh-te", "the-thao", "chinh-tri", "thoi-su", "giao-duc", "cong-nghe", "doi-song", "phap-luat",
    "suc-khoe", "giai-tri", "du-lich", "quan-su", "kinh-doanh", "van-hoa", "khoa-hoc", "y-te", "oto-xe-may", "bat-dong-san",
    "tai-chinh", "chung-khoan", "thi-truong",
    "tin tức", "tin mới", "tin mới nhất", "tin nóng", "tin hot", "tin tức 24h", "tin tức trong ngày", "tin nhanh", "trang chủ",
    "video", "ảnh", "hình ảnh", "infographic", "podcast", "longform", "bình luận", "ý kiến", "góc nhìn", "phân tích", "xã luận",
    "tin tức mới", "tin tức nóng", "thời sự nóng",
    "asean", "châu á", "châu âu", "châu mỹ", "châu phi", "trung đông", "châu á - thái bình dương", "châu á thái bình dương",
    "chau-a-tbd", "chau-au", "chau-my", "chau-phi", "trung-dong",
]

# Patterns of what is no entity, as Java regular expressions.
DATE_LIKE = r"(?iu)^(năm|tháng|ngày|tuần|giờ|phút|quý|thế\s*kỷ|thập\s*kỷ)\s*\p{Nd}"
NUMERIC = r"^[\p{Nd}\s,.\-+]+$"
PERCENT = r"[%‰]"
CURRENCY = r"(?iu)(USD|VND|EUR|JPY|CNY|đ|đồng|tỷ|triệu|nghìn)\s*$"
EDGE_PUNCTUATION = r"[\s,.;:!?\-–—(){}\[\]'\"“”‘’]+"

#: Where a site keeps an article's body, first match first.
BODY_SELECTORS = {
    "vnexpress.net": [".fck_detail", "article.fck_detail"],
    "dantri.com.vn": ["div.e-magazine__body", "article.dt-flex", "article", ".singular-content", ".dt-news__content", ".detail-content"],
    "tuoitre.vn": [".detail-content", ".content-detail", "article.detail"],
    "thanhnien.vn": [".detail-cmain", ".detail__content"],
    "vietnamnet.vn": [".maincontent", ".content-detail"],
    "laodong.vn": ["div.art-body", "article.article-detail", ".art-body", ".detail-content"],
    "nld.com.vn": [".detail-content", "article .detail-cmain"],
    "vietnamplus.vn": [".article-body", ".article__body", ".the-article-body"],
    "soha.vn": [".detail-content-body", ".news-content"],
    "nhandan.vn": [".article__body", ".detail-content"],
    "baotintuc.vn": [".detail-content", ".article-body"],
    "kienthuc.net.vn": [".article-body", ".the-article-body"],
    "znews.vn": [".the-article-body", "article .article-content"],
    "24h.com.vn": [".text-conent", ".cate-24h-foot-home-detail-cmain", ".detail-news-content"],
}
#: Parts of a body that aren't the article.
NOISE_TAGS = ["script", "style", "noscript", "iframe", "figcaption"]
NOISE_CLASSES = [
    "ads", "ad-container", "advertisement", "related-news", "related-articles", "box-tinlienquan", "social-share", "share-bar",
    "share-box", "comment", "comments", "author-box", "author-info", "newsletter", "subscribe",
]
NOISE_IDS = ["comments"]

# Thresholds.
MIN_LENGTH_RSS, MIN_LENGTH_HTML, FULL_LENGTH, MIN_LENGTH_CLEAN = 100, 300, 500, 200
ENTITY_LENGTHS, NER_LENGTHS, NER_CHARS = (2, 50), (2, 60), 5000
