"""Values that have to be exactly these for results to be right.

Everything in this module is a fixed value: source field names in lookup order,
code tables, lexicons, patterns and schema text. No logic lives here.
"""

# ---------------------------------------------------------------------------
# Daily table schemas, one "name type" pair per column, in order.
# ---------------------------------------------------------------------------
SILVER_COLUMNS = {
    "preorder": (
        "campaign_id bigint, maker_id bigint, maker_name string, corp_name string, title string, "
        "category_code string, category_name string, core_message string, open_ts timestamp_ntz, "
        "close_ts timestamp_ntz, snapshot_dt string, snapshot_ts timestamp_ntz, remaining_day bigint, "
        "remaining_days_at_snapshot bigint, achievement_rate double, funding_ratio double, "
        "target_amount bigint, total_funding_amount bigint, participation_cnt bigint, signature_cnt bigint, "
        "status_simplified string, biz_model string, is_adult boolean, has_coupon boolean, "
        "maker_club_grade string, is_delivery_available boolean, is_global_shipping_available boolean, "
        "thumbnail_url string, silver_processed_at timestamp_ntz, dt string"
    ),
    "comments": (
        "comment_id string, campaign_id bigint, comment_type string, depth bigint, author_id_hash string, "
        "comment_ts timestamp_ntz, comment_date string, content_length bigint, comment_body_cleaned string, "
        "parent_comment_id string, is_answered boolean, time_to_first_answer_min double, "
        "keyword_groups string, sentiment_score bigint, sentiment_label string, "
        "contains_question_mark boolean, is_maker boolean, is_owner boolean, is_supporter boolean, "
        "silver_processed_at timestamp_ntz, dt string"
    ),
    "supporter": (
        "user_id_hash string, campaign_id bigint, supporter_type string, backing_amount bigint, "
        "participated_at timestamp_ntz, participated_date string, is_purchaser boolean, is_signer boolean, "
        "raw_support_type string, dont_show_amount boolean, is_active_user boolean, has_membership boolean, "
        "silver_processed_at timestamp_ntz, dt string"
    ),
    "fundings": (
        "user_id_hash string, campaign_id bigint, action_type string, amount bigint, "
        "funded_at timestamp_ntz, funded_date string, funded_hour bigint, funded_dow bigint, "
        "amount_tier string, campaign_title string, product_type string, remaining_day_at_snapshot bigint, "
        "achievement_rate_at_snapshot double, silver_processed_at timestamp_ntz, dt string"
    ),
    "wishes": (
        "user_id_hash string, campaign_id bigint, snapshot_at timestamp_ntz, snapshot_dt string, "
        "wish_snapshot_date string, campaign_title string, maker_name string, "
        "achievement_rate_at_wish_snapshot double, remaining_day_at_wish_snapshot bigint, "
        "amount_at_wish_snapshot bigint, product_type string, is_active_at_snapshot boolean, "
        "silver_processed_at timestamp_ntz, dt string"
    ),
    "user_info": (
        "user_id_hash string, signature_count bigint, total_funding_count bigint, follower_cnt bigint, "
        "following_cnt bigint, interest_count bigint, is_membership_user boolean, user_segment string, "
        "snapshot_dt string, silver_processed_at timestamp_ntz, dt string"
    ),
    "detail": (
        "campaign_id bigint, raw_title string, crawl_status string, collected_ts timestamp_ntz, "
        "is_error boolean, error_type string, silver_processed_at timestamp_ntz, dt string"
    ),
}

# Required, dedup and sort keys of each daily table.
SILVER_KEYS = {
    "preorder": (
        ["campaign_id", "snapshot_ts", "dt"],
        ["campaign_id", "snapshot_ts"],
        ["campaign_id", "snapshot_ts"],
    ),
    "comments": (
        ["comment_id", "campaign_id", "dt"],
        ["comment_id"],
        ["campaign_id", "comment_ts", "comment_id"],
    ),
    "supporter": (
        ["user_id_hash", "campaign_id", "dt"],
        ["user_id_hash", "campaign_id", "participated_at", "supporter_type"],
        ["campaign_id", "participated_at", "user_id_hash"],
    ),
    "fundings": (
        ["user_id_hash", "campaign_id", "dt"],
        ["user_id_hash", "campaign_id", "funded_at", "amount"],
        ["user_id_hash", "funded_at"],
    ),
    "wishes": (
        ["user_id_hash", "campaign_id", "dt"],
        ["user_id_hash", "campaign_id", "snapshot_dt"],
        ["user_id_hash", "snapshot_dt", "campaign_id"],
    ),
    "user_info": (
        ["user_id_hash", "dt"],
        ["user_id_hash", "snapshot_dt"],
        ["user_id_hash", "snapshot_dt"],
    ),
    "detail": (
        ["campaign_id", "dt"],
        ["campaign_id", "dt"],
        ["campaign_id", "dt"],
    ),
}

# ---------------------------------------------------------------------------
# Columns whose missing values become 0, '' or false.
# ---------------------------------------------------------------------------
ZERO_WHEN_MISSING = frozenset(
    "participation_cnt signature_cnt content_length remaining_day remaining_days_at_snapshot follower_cnt "
    "following_cnt interest_count signature_count total_funding_count target_amount total_funding_amount "
    "backing_amount amount amount_at_wish_snapshot".split()
)
EMPTY_WHEN_MISSING = frozenset(
    "title raw_title maker_name corp_name core_message comment_body_cleaned campaign_title crawl_status "
    "error_type keyword_groups sentiment_label category_name status_simplified biz_model".split()
)
FALSE_WHEN_MISSING = frozenset(
    "is_adult has_coupon is_delivery_available is_global_shipping_available is_purchaser is_signer "
    "dont_show_amount is_active_user has_membership is_membership_user is_answered contains_question_mark "
    "is_maker is_owner is_supporter is_error is_active_at_snapshot".split()
)

# ---------------------------------------------------------------------------
# Source field names per output column, in lookup order.
# ---------------------------------------------------------------------------
PREORDER_FIELDS = {
    "campaign_id": "campaign_id campaignId campaignid project_id projectId id",
    "maker_id": "maker_id makerId userId userid",
    "maker_name": "maker_name makerName makername nickName nickname",
    "corp_name": "corp_name corpName corpname",
    "title": "title campaignTitle projectTitle",
    "category_code": "category_code categoryCode categorycode category custValueCodeNm",
    "category_name": "category_name categoryName categoryname custValueCodeNm",
    "core_message": "core_message coreMessage coremessage summary",
    "open_ts": "open_ts whenOpen startDateTime openDateTime",
    "close_ts": "close_ts closeDateTime endDateTime",
    "snapshot_ts": "snapshot_ts collected_ts collectedAt crawl_ts _parent_collected_at",
    "remaining_day": "remaining_day remainingDay remainingday",
    "remaining_days_at_snapshot": "remaining_days_at_snapshot remainingDay remainingday remaining_day",
    "achievement_rate": "achievement_rate achievementRate achievementrate",
    "funding_ratio": "funding_ratio fundingRatio fundingratio",
    "target_amount": "target_amount targetAmount targetamount",
    "total_funding_amount": (
        "total_funding_amount totalBackedAmount totalbackedamount funding_amount fundingAmount amount"
    ),
    "participation_cnt": "participation_cnt participationCnt participationcnt supporter_count supporterCount",
    "signature_cnt": "signature_cnt signatureCnt signaturecnt",
    "status_simplified": "status_simplified status",
    "biz_model": "biz_model productType product_type producttype",
    "is_adult": "is_adult isAdult adult",
    "has_coupon": "has_coupon hasCoupon hascoupon",
    "maker_club_grade": "maker_club_grade makerClubGrade makerclubgrade",
    "is_delivery_available": "is_delivery_available isDeliveryAvailable isdeliveryavailable",
    "is_global_shipping_available": (
        "is_global_shipping_available isGlobalShippingAvailable isglobalshippingavailable"
    ),
    "thumbnail_url": "thumbnail_url photoUrl imageUrl thumbnail",
}
COMMENT_FIELDS = {
    "comment_id": "comment_id commentId id boardId raw.boardId",
    "campaign_id": "campaign_id campaignId campaignid commonId raw.commonId raw.campaignId",
    "comment_type": "comment_type commentType raw.commentType type",
    "depth": "depth commentDepth raw.depth",
    "author_id": "author_id authorId user_id userId encUserId raw.encUserId raw.userFollow.userId",
    "comment_ts": "comment_ts createdAt created_at registeredAt whenCreated raw.whenCreated",
    "comment_body": "comment_body body content text comment raw.body",
    "parent_comment_id": "parent_comment_id parentCommentId parentBoardId raw.parentBoardId",
    "is_answered": "is_answered answered isAnswered hasReply raw.hasReply",
    "time_to_first_answer_min": "time_to_first_answer_min",
    "is_maker": "is_maker isMaker maker raw.maker",
    "is_owner": "is_owner isOwner owner raw.owner",
    "is_supporter": "is_supporter isSupporter support raw.support",
}
SUPPORTER_FIELDS = {
    "user_id": "user_id userId memberId supporterId encUserId raw.encUserId raw.userInfo.userId",
    "campaign_id": "campaign_id campaignId campaignid project_id projectId commonId",
    "supporter_type": "supporter_type supportType type raw.type",
    "backing_amount": "backing_amount amount fundingAmount backedAmount raw.backedAmount",
    "participated_at": "participated_at participatedAt createdAt whenCreated raw.whenCreated",
    "dont_show_amount": "dont_show_amount dontShowAmount raw.dontShowAmount",
    "is_active_user": "is_active_user isActiveUser activeUser raw.activeUser",
    "has_membership": "has_membership hasMembership raw.hasMembership",
}
FUNDING_FIELDS = {
    "user_id": "user_id userId userid encUserId enc_user_id _parent_user_id",
    "campaign_id": "campaign_id campaignId campaignid project_id projectId id",
    "amount": "amount backedAmount backed_amount funding_amount fundingAmount",
    "campaign_title": "campaign_title campaignTitle title projectTitle",
    "product_type": "product_type productType producttype",
    "funded_at": (
        "funded_at fundedAt created_at createdAt whenCreated collected_at collectedAt _parent_collected_at"
    ),
    "remaining_day_at_snapshot": "remaining_day_at_snapshot remainingDay remainingday remaining_day",
    "achievement_rate_at_snapshot": "achievement_rate_at_snapshot achievementRate achievementrate",
}
WISH_FIELDS = {
    "user_id": "user_id userId userid encUserId enc_user_id _parent_user_id",
    "campaign_id": "campaign_id campaignId campaignid project_id projectId id",
    "snapshot_at": (
        "snapshot_at snapshotAt collected_at collectedAt _parent_collected_at created_at createdAt whenCreated"
    ),
    "campaign_title": "campaign_title campaignTitle title projectTitle",
    "maker_name": "maker_name makerName makername nickName nickname",
    "achievement_rate_at_wish_snapshot": (
        "achievement_rate_at_wish_snapshot achievementRate achievementrate achievement_rate"
    ),
    "remaining_day_at_wish_snapshot": "remaining_day_at_wish_snapshot remainingDay remainingday remaining_day",
    "amount_at_wish_snapshot": (
        "amount_at_wish_snapshot amount totalBackedAmount totalbackedamount fundingAmount funding_amount"
    ),
    "product_type": "product_type productType producttype",
    "ended_flag": "endYn endyn end_yn isEnded is_ended",
    "remaining_for_active": "remainingDay remainingday remaining_day remaining_day_at_snapshot",
}
USER_INFO_FIELDS = {
    "user_id": "user_id userId userid encUserId enc_user_id _parent_user_id data.userInfo.userId",
    "signature_count": "signature_count signatureCnt signaturecnt data.signatureCnt",
    "total_funding_count": "total_funding_count totalFundingCount totalfundingcount data.totalFundingCount",
    "follower_cnt": "follower_cnt followerCnt followercnt data.followerCnt",
    "following_cnt": "following_cnt followingCnt followingcnt data.followingCnt",
    "interests": "interestKeyword interest_keyword interests data.interestKeyword",
    "is_membership_user": (
        "is_membership_user isValidJoinedPremiumMembership hasMembership has_membership "
        "data.isValidJoinedPremiumMembership"
    ),
    "collected_at": "collected_at collectedAt _parent_collected_at snapshot_at snapshotAt",
}
DETAIL_FIELDS = {
    "campaign_id": "campaign_id campaignId project_id projectId id",
    "raw_title": "raw_title title",
    "crawl_status": "crawl_status status",
    "collected_ts": "collected_ts collectedAt crawl_ts",
    "is_error": "is_error isError",
    "error_type": "error_type errorType",
}

# Wrapper fields that may hold the list of records, in lookup order.
WRAPPER_LIST_FIELDS = "data items content result results fundings wishes".split()
TABLES_OF_WRAPPERS = ("fundings", "wishes")
PARENT_FIELDS = ("user_id", "collected_at")
SEED_LIST_FIELDS = "records data rows items content projectList".split()

# Id field names for seeding, in lookup order.
SEED_CAMPAIGN_ID_FIELDS = "campaignId campaign_id projectId project_id id".split()
SEED_USER_ID_FIELDS_NESTED = (
    "encUserId userId user_id enc_user_id supporterId supporter_id memberId member_id".split()
)
SEED_USER_ID_FIELDS_TOP = (
    "encUserId user_id userId enc_user_id supporterId supporter_id memberId member_id".split()
)
NOT_A_USER_ID = "none null nan".split()

# Patterns.
USER_ID_IN_PATH = r"user_id=([^/]+?)\.json"
HOUR_IN_PATH = r"hour=(\d{2})"
PURCHASER_PATTERN = "purchase|fund|back|preorder|reward|구매|펀딩"
SIGNER_PATTERN = "sign|signature|지지"
QUESTION_PATTERN = "[?？]|나요|까요|문의"
TAG_PATTERN = "<[^>]+>"
CONTROL_PATTERN = r"[\x00-\x1f\x7f]"

# Accepted spellings of true and false.
TRUE_WORDS = "true 1 y yes t".split()
FALSE_WORDS = "false 0 n no f".split()

# Code tables.
CATEGORY_NAMES = {"TECH": "테크/가전", "FASHION": "패션/잡화", "BEAUTY": "뷰티", "FOOD": "푸드", "LIVING": "리빙"}
STATUS_NAMES = {"OPEN": "진행중", "COMING_SOON": "오픈예정", "CLOSED": "종료", "SUCCESS": "성공", "FAILED": "실패"}
BIZ_MODEL_NAMES = {"PREORDER": "예약구매", "FUNDING": "펀딩", "STORE": "스토어"}
FUNDING_PRODUCT_TYPES = ["REWARD", "PREORDER", "FUNDING"]

# Comment lexicons and keyword groups, in rule order.
POSITIVE_KEYWORDS = "기대 좋아요 좋습니다 만족 예쁘 편하 기다렸 응원 구매완료 추천 감사 최고".split()
NEGATIVE_KEYWORDS = "배송 언제 취소 환불 불량 늦 실망 문의 문제 안됨 고장 누락 교환 지연".split()
KEYWORD_GROUPS = {
    "delivery": "배송 출고 도착 택배 지연".split(),
    "refund_cancel": "환불 취소 교환 반품".split(),
    "quality_issue": "불량 고장 문제 하자 누락".split(),
    "expectation": "기대 기다렸 응원".split(),
    "purchase_intent": "구매 결제 펀딩 재구매".split(),
    "usage": "사용 설치 방법 문의".split(),
}

# Fixed values: (upper bound exclusive, name) of funding amount tiers; user segments.
AMOUNT_TIERS = [(30000, "under_30k"), (100000, "30k_100k"), (300000, "100k_300k")]
AMOUNT_TIER_TOP = "over_300k"
AMOUNT_TIER_NONE = "unknown"

# Dashboard column lookups, date columns and sentiment spellings.
CAMPAIGN_ID_COLUMNS = ["campaign_id", "campaignId", "project_id", "projectId"]
DATE_COLUMNS = ["date", "dt", "base_dt", "event_date", "when_created"]
DATE_LIKE_COLUMNS = frozenset(
    "dt date base_dt event_date created_date when_created start_datetime end_datetime collected_at".split()
)
DATE_LIKE_SUFFIXES = ("_date", "_datetime", "_ts")
SENTIMENT_SPELLINGS = {
    "positive": (["positive", "pos", "긍정"], "positive|긍정"),
    "negative": (["negative", "neg", "부정"], "negative|부정"),
}

# Columns of the public campaign view (no maker_id).
PUBLIC_CAMPAIGN_COLUMNS = (
    "campaign_id title category_name category_code biz_model status_simplified maker_name corp_name "
    "core_message maker_club_grade has_coupon is_delivery_available is_global_shipping_available open_ts "
    "close_ts snapshot_dt snapshot_ts remaining_day remaining_day_label achievement_rate funding_ratio "
    "target_amount total_funding_amount participation_cnt signature_cnt supporter_user_cnt purchaser_cnt "
    "signer_user_cnt supporter_backing_amount avg_supporter_backing_amount arppu wish_user_cnt comment_cnt "
    "question_cnt answer_cnt avg_sentiment_score positive_comment_cnt negative_comment_cnt "
    "neutral_comment_cnt reaction_cnt dt"
).split()

# Where the figures of a campaign's snapshot stand, by the names a mart may use. The
# first list is for the daily mart, the second for the campaign mart.
SNAPSHOT_COLUMNS = {
    "amount": (["total_funding_amount"], ["total_funding_amount", "total_backed_amount"]),
    "achievement": (["achievement_rate"], ["achievement_rate"]),
    "participation": (["participation_cnt", "supporter_count"], ["participation_cnt", "supporter_count"]),
    "signature": (["signature_cnt"], ["signature_cnt"]),
    "daily_views": (["detail_views", "detail_view_cnt"], []),
    "daily_conversion": (["daily_conversion_rate"], []),
    "comments": (["comment_cnt", "comment_count"], ["comment_cnt", "comment_count"]),
}
HEADLINE_RATES = ["view_to_participation_rate", "wish_to_participation_rate"]
