"""Phrases that paywalls use."""

# English phrases.
ENGLISH = [
    "subscribe", "subscription", "sign up", "subscribe now", "register", "register now",
    "become a subscriber", "exclusive content", "member", "membership", "paywall", "pay", "payment",
    "purchase", "paid content", "buy now", "access to", "read more", "continue reading",
    "read the full article", "log in to read more", "unlock", "access", "get access", "full access",
    "free trial", "start your free trial", "trial period", "login", "log in", "already a subscriber?",
    "only available to subscribers", "upgrade", "upgrade your plan", "sign in", "sign in to continue",
    "premium", "join now", "create an account", "limited access", "exclusive access",
    "premium content", "exclusive articles", "limited content", "subscription required", "password",
]

# Arabic phrases, each once.
ARABIC = [
    "اشترك", "اشتراك", "سجل", "اشترك الآن", "تسجيل", "سجل الآن", "كن مشتركًا", "محتوى حصري", "عضو",
    "عضوية", "حاجز دفع", "ادفع", "دفع", "شراء", "محتوى مدفوع", "اشترِ الآن", "الوصول إلى", "اقرأ المزيد",
    "استمر في القراءة", "اقرأ المقال كاملاً", "سجل الدخول لقراءة المزيد", "افتح", "وصول", "احصل على وصول",
    "وصول كامل", "تجربة مجانية", "ابدأ تجربتك المجانية", "فترة تجريبية", "تسجيل الدخول",
    "هل أنت مشترك بالفعل؟", "متاح فقط للمشتركين", "ترقية", "قم بترقية خطتك", "تسجيل الدخول للمتابعة",
    "بريميوم", "انضم الآن", "أنشئ حسابًا", "وصول محدود", "وصول حصري", "محتوى بريميوم", "مقالات حصرية",
    "محتوى محدود", "يتطلب الاشتراك", "كلمة المرور",
]
