"""Fixed values of the Taiwanese rule pack: word lists that decide what is found, in plain text."""

# ---- fixed values ------------------------------------------------------------------------------------------------

COMPOUND_SURNAMES = (
    "歐陽", "司馬", "上官", "諸葛", "夏侯", "皇甫", "尉遲", "公孫", "慕容", "司徒", "司空",
)
SURNAMES = (
    "趙", "錢", "孫", "李", "周", "吳", "鄭", "王", "馮", "陳", "蔣", "沈", "韓", "楊", "朱", "秦", "尤", "許", "何", "呂", "施", "張", "曹", "嚴", "華", "金", "魏", "陶", "姜",
    "謝", "鄒", "蘇", "潘", "葛", "范", "彭", "魯", "韋", "馬", "苗", "方", "俞", "任", "袁", "柳", "史", "唐", "薛", "雷", "賀", "倪", "湯", "殷", "羅", "畢", "郝", "安", "常",
    "樂", "于", "傅", "齊", "康", "伍", "余", "顧", "孟", "平", "黃", "蕭", "尹", "姚", "邵", "汪", "祁", "毛", "狄", "米", "貝", "戴", "宋", "龐", "熊", "紀", "舒", "屈", "項",
    "祝", "董", "梁", "杜", "阮", "藍", "閔", "席", "季", "賈", "路", "江", "童", "顏", "郭", "梅", "盛", "林", "鍾", "徐", "邱", "高", "夏", "蔡", "田", "樊", "胡", "凌", "霍",
    "萬", "柯", "盧", "莫", "房", "裘", "解", "應", "丁", "鄧", "洪", "包", "左", "石", "崔", "龔", "程", "邢", "裴", "陸", "翁", "牛", "侯", "全", "白", "賴", "卓", "池", "喬",
    "溫", "莊", "廖", "簡", "饒", "曾", "連", "游", "葉", "劉", "詹", "黎", "費", "章", "歐", "龍", "芮", "巫", "沙", "向", "古", "易", "辛",
)
LATIN_STOP = (
    "LINE PAY", "APPLE PAY", "GOOGLE PAY", "GOOGLE MAP", "QR CODE", "PRO MAX", "OPPO RENO", "SAMSUNG GALAXY", "IPHONE XR", "IPHONE SE",
    "CARGO RECEIPT", "STATEMENT OF FACTS", "MADE IN VIETNAM", "ALL IN", "THE NORTH FACE", "UNDER ARMOUR", "LINE VOOM", "VPLUS GOLF",
    "EFFERALGAN CODEINE", "EFFERALGAN PARACETAMOL", "ULTRA COMPACT PRO", "TEREA MENTHOL", "TEREA PURPLE MENTHOL", "MI-NE ORIGINAL",
    "DOUBLE HAPPINESS VIRGINIA",
)
NOT_NAMES = (
    "上列", "本件", "本案", "其等", "渠等", "因而", "因此", "部分", "方面", "所為", "犯意", "罪嫌", "前科", "年籍", "住居", "坦承", "自白", "辯稱", "供稱", "聲稱", "表示", "主張", "陳稱", "及其",
    "與其", "於本院", "在本院", "之行為", "之犯行", "之供述", "之證述", "之姓名", "之身分", "經本院", "到庭", "提起", "偵辦", "執行", "聲請", "起訴", "移送", "依法", "係犯", "所有", "所騎", "所駕",
    "所受", "遭受", "犯竊盜", "犯詐欺", "未到庭", "被告", "被害人", "告訴人", "證人", "受刑人", "檢察官", "法官", "書記官", "施用前", "應依累", "詳下述", "以上", "提起公訴並", "提起公訴及", "追加起訴並",
    "辯護人", "選任辯護人", "律師", "附錄", "簡易程", "簡易庭", "方法", "詐騙方式", "匯款時間", "匯款金額", "匯入帳戶", "編號", "證據名稱", "身分傳喚", "身分傳喚甲", "身分傳喚乙", "身分傳喚丙", "童頭部", "凌虐",
)
CITIES = (
    "臺北市", "台北市", "新北市", "桃園市", "臺中市", "台中市", "臺南市", "台南市", "高雄市", "基隆市", "新竹市", "嘉義市", "新竹縣", "苗栗縣", "彰化縣", "南投縣", "雲林縣", "嘉義縣", "屏東縣", "宜蘭縣",
    "花蓮縣", "臺東縣", "台東縣", "澎湖縣", "金門縣", "連江縣",
)
ORG_BAD = (
    "被告", "原告", "告訴人", "本案", "前揭", "上開", "該銀行", "自用", "普通", "小客車", "機車", "帳戶", "密碼", "犯罪", "判決", "行車路線", "居所", "自陳", "自述", "警詢", "審理", "等人", "所示",
    "金融機構帳號", "提款卡", "申請", "客服", "之前有跟", "自己向", "附表", "證人", "證述",
)
ORG_GENERIC = (
    "網路銀行", "連結銀行", "銀行", "醫院", "大學", "高中", "國中", "國小", "餐廳", "酒店", "旅館", "公司", "有限公司", "股份有限公司", "便利商店", "家股份有限公司",
)
SPACED_TERMS = (
    "中華民國", "公訴人", "聲請人", "自訴人", "被告", "被害人", "告訴人", "證人", "辯護人", "代理人", "法定代理人", "選任辯護人", "指定辯護人", "審判長法官", "檢察官", "法官", "書記官", "主文", "理由",
)
TITLES = (
    "審判長法官", "法官", "檢察官", "書記官", "選任辯護人", "指定辯護人", "辯護人", "告訴代理人", "自訴代理人", "司法警察官", "員警",
)
VOLUMES = (
    "本院卷", "院卷", "偵查卷", "刑案偵查卷", "偵卷", "警卷", "簡字卷", "審理卷",
)
FOLLOWS = (
    "於", "在", "因", "與", "騎", "駕", "搭", "甫從", "甫於", "前往", "基於", "明知", "意圖", "持", "將", "向", "遂", "旋即", "遭", "受有", "陳稱", "表示", "主張", "指述", "證稱", "坦承",
    "供稱", "辯稱", "犯", "涉", "」", "”", "提起", "到庭", "執行", "偵辦", "聲請", "具結", "所有", "所騎", "所駕", "所受", "撤回", "律師",
)
ORG_SPLIT = (
    "委託不知情之", "及不知情之", "名下所有之", "所申設之", "行車路線自", "欲駛入", "前往", "離開", "設於", "搭載", "明知", "委託", "送往", "出具", "附載", "應與", "使用", "郵寄", "旁之", "復有", "另有",
    "並有", "名下", "至", "往", "於", "在", "為", "與", "及", "之",
)
JURISDICTIONS = (
    "臺北", "台北", "士林", "新北", "宜蘭", "基隆", "桃園", "新竹", "苗栗", "臺中", "台中", "彰化", "南投", "雲林", "嘉義", "臺南", "台南", "高雄", "橋頭", "花蓮", "臺東", "台東", "屏東", "澎湖",
    "金門", "連江",
)
NAME_HEADS = (
    "本", "該", "其", "上", "下", "前", "同", "之", "或", "及", "並", "另", "再", "均",
)
